"""Queries: statistics, fingerprint de-dup, draws, fences, split (mix stage)."""

from __future__ import annotations

from pyspark.sql import functions as F

from mcqflow.functions.text import blank_to_empty, total_length
from mcqflow.operators.clean import annotate, classify
from mcqflow.operators.dedup import (duplicate_stats, fingerprint, fingerprint_dedupe, fingerprint_groups, group_lengths,
                                     incremental_dedupe, unique_fingerprints)
from mcqflow.operators.index import MAX_INT_BUCKETS, int_bucket, ranked
from mcqflow.operators.sample import (fence_stats, group_targets, outlier_filter, outlier_flag,
                                      outlier_refill, outlier_rows, ratio_mix, split_flags,
                                      length_parts, stratified_sample, with_shuffle_rank)
from mcqflow.operators.stats import length_distribution
from mcqflow.plans.oracle_sql import (CLASSIFIED, GROUPS, LOWER_STRIP, MCQ, TWINS, VALID,
                                      classified_cte, with_ctes)
from mcqflow.plans.q_clean import valid
from mcqflow.plans.registry import register
from mcqflow.session import materialize
from mcqflow.operators.index import join_small
from mcqflow.sources.fixtures import GROUP_RATIOS, ROW_ID, group_config, load_mcq, read_table, with_twins

MIX_SHARE = 0.6  # mix total = floor(0.6 x input documents)


# what de-dup, draw, fence and reports need of a row; its text stays in the scan
POOL_COLUMNS = ["index", "dataset", "grp", "source", "label"]


def pool(spark, sf):
    """Valid rows of the adapter plus its twins, with group and dataset order: one
    scan of the texts gives the verdict, fingerprint and lengths of each."""
    rows = with_twins(load_mcq(spark, sf, row_id=True))
    c = classify(rows, ["dataset"], keep=[*POOL_COLUMNS, *ROW_ID],
                 derive={"fp": fingerprint(), "length": total_length(), **group_lengths()}).where(F.col("reason").isNull())
    c = join_small(c, group_config(spark).select("grp", "grp_ord"), ["grp"], bound=len(GROUP_RATIOS))
    return c.withColumn("dataset_ord", F.when(F.col("dataset") == "src_twin", 1).otherwise(0))


def pool_rows(spark, sf):
    """The texts, questions and repaired options behind ``pool``, by dataset and row id."""
    return annotate(with_twins(load_mcq(spark, sf, row_id=True))).select("dataset", *ROW_ID, "text", "question", "options")


def deduped_pool(spark, sf):
    return materialize(fingerprint_dedupe(pool(spark, sf)), "deduped_pool")


def mix_total(spark, sf):
    docs = read_table(spark, sf, "documents")
    return docs.agg(F.floor(F.count(F.lit(1)) * F.lit(MIX_SHARE)).alias("t")).select("t").scalar()


def drawn(spark, sf):
    p = deduped_pool(spark, sf).where("is_first")
    return materialize(ratio_mix(p, group_config(spark), mix_total(spark, sf)), "drawn")


def valid_len(spark, sf, keep=("index",), derive=None):
    return valid(spark, sf, keep=list(keep), derive={"length": total_length(), **(derive or {})})


# ---------------------------------------------------------------- SQL ------
POOL = (TWINS + ",\n" + classified_cte("twins", "ctw") + ",\n" + GROUPS + """,
pool AS (SELECT c.*, g.grp_ord, CASE WHEN c.dataset = 'src_twin' THEN 1 ELSE 0 END AS dataset_ord
         FROM ctw c JOIN groups g USING (grp) WHERE c.reason IS NULL),
fp AS (SELECT *,
    row_number() OVER (PARTITION BY """ + LOWER_STRIP("text") + ", " + LOWER_STRIP("question") + """,
        list_transform(options, lambda o: """ + LOWER_STRIP("o") + """)
        ORDER BY grp_ord, dataset_ord, "index") = 1 AS is_first,
    count(*) OVER (PARTITION BY """ + LOWER_STRIP("text") + ", " + LOWER_STRIP("question") + """,
        list_transform(options, lambda o: """ + LOWER_STRIP("o") + """)) AS fp_count,
    min("index") OVER (PARTITION BY """ + LOWER_STRIP("text") + ", " + LOWER_STRIP("question") + """,
        list_transform(options, lambda o: """ + LOWER_STRIP("o") + """)) AS fp_id
  FROM pool)""")

TOTAL = "(SELECT CAST(floor(count(*) * 0.6::DOUBLE) AS BIGINT) FROM documents)"

DRAWN = """drawn AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT f.*, CAST(floor(""" + TOTAL + """ * g.ratio) AS BIGINT) AS target,
      row_number() OVER (PARTITION BY f.grp ORDER BY md5('42:' || f.dataset || ':' || CAST(f."index" AS VARCHAR))) AS rn
    FROM fp f JOIN groups g USING (grp) WHERE f.is_first)
  WHERE rn <= target)"""

LEN = "(length(text) + length(question) + list_sum(list_transform(options, lambda o: length(o))))"

VLEN = "vlen AS (SELECT *, CAST(" + LEN + " AS BIGINT) AS length FROM valid)"

FENCE = """fence AS (SELECT q[1] AS q1, q[2] AS median, q[3] AS q3, q[3] - q[1] AS iqr,
    q[3] + 1.5 * (q[3] - q[1]) AS upper FROM (SELECT quantile_cont(length, [0.25, 0.5, 0.75]) AS q FROM vlen))"""

KEPT = "kept AS (SELECT v.* FROM vlen v WHERE v.length <= (SELECT upper FROM fence))"

SPLIT = """ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || dataset || ':' || CAST("index" AS VARCHAR))) AS rn,
    count(*) OVER () AS n FROM kept),
flags AS (SELECT *, rn > n - floor(n * 0.1::DOUBLE) AS is_eval FROM ranked),
split AS (SELECT *, NOT is_eval AND rn <= floor(n * 0.9::DOUBLE) AS is_full,
    NOT is_eval AND rn <= floor(n * 0.45::DOUBLE) AS is_peft FROM flags)"""


# ------------------------------------------------------------- stats -------
@register("dataset_stats", with_ctes(MCQ, CLASSIFIED, VALID) + """
SELECT source AS dataset, count(*) AS n, round(avg(length(coalesce(text, ''))), 6) AS avg_text_length,
       round(avg(len(options)), 6) AS avg_opt_count
FROM valid GROUP BY source""")
def dataset_stats(spark, sf):
    """A1: per dataset (source) count, mean text length, mean option count."""
    v = valid(spark, sf, keep=["source"], derive={"text_length": F.length(blank_to_empty("text")), "opt_count": F.size("options")})
    return v.groupBy(F.col("source").alias("dataset")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("text_length"), 6).alias("avg_text_length"),
        F.round(F.avg("opt_count"), 6).alias("avg_opt_count"))


@register("dataset_optcount_hist", with_ctes(MCQ, CLASSIFIED, VALID) + """
SELECT source AS dataset, CAST(len(options) AS BIGINT) AS opt_count, count(*) AS n
FROM valid GROUP BY 1, 2""")
def dataset_optcount_hist(spark, sf):
    """A1 histogram: per dataset and option count."""
    return (valid(spark, sf, keep=["source"], derive={"opt_count": F.size("options").cast("bigint")})
            .groupBy(F.col("source").alias("dataset"), "opt_count").agg(F.count(F.lit(1)).alias("n")))


@register("source_dist", with_ctes(MCQ, CLASSIFIED, VALID) + """
SELECT source, count(*) AS n FROM valid GROUP BY source""")
def source_dist(spark, sf):
    return valid(spark, sf, keep=["source"]).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@register("optcount_dist", with_ctes(MCQ, CLASSIFIED, VALID) + """
SELECT CAST(len(options) AS BIGINT) AS opt_count, count(*) AS n FROM valid GROUP BY 1""")
def optcount_dist(spark, sf):
    return (valid(spark, sf, derive={"opt_count": F.size("options").cast("bigint")}).groupBy("opt_count")
            .agg(F.count(F.lit(1)).alias("n")))


@register("label_dist", with_ctes(MCQ, CLASSIFIED, VALID) + """
SELECT label, count(*) AS n FROM valid GROUP BY label""")
def label_dist(spark, sf):
    return valid(spark, sf, keep=["label"]).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@register("length_quintiles", with_ctes(MCQ, CLASSIFIED, VALID) + """,
tl AS (SELECT length(text) AS v FROM valid),
e AS (SELECT quantile_cont(v, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM tl),
ok AS (SELECT len(list_distinct(q)) = 6 AS ok FROM e),
bins AS (SELECT CASE WHEN v <= q[2] THEN 'very_short' WHEN v <= q[3] THEN 'short'
    WHEN v <= q[4] THEN 'medium' WHEN v <= q[5] THEN 'long' ELSE 'very_long' END AS key
  FROM tl, e),
hist AS (SELECT v, count(*) AS c FROM tl GROUP BY v),
cum AS (SELECT v, sum(c) OVER (ORDER BY v) AS cum FROM hist)
SELECT key, CAST(count(*) AS DOUBLE) AS value FROM bins WHERE (SELECT ok FROM ok) GROUP BY key
UNION ALL
SELECT * FROM (
  SELECT 'min' AS key, CAST(min(v) AS DOUBLE) AS value FROM tl
  UNION ALL SELECT 'max', CAST(max(v) AS DOUBLE) FROM tl
  UNION ALL SELECT 'mean', round(avg(v), 6) FROM tl
  UNION ALL SELECT 'median', CAST(min(v) AS DOUBLE) FROM cum
     WHERE cum >= (SELECT count(*) FROM tl) // 2 + 1) WHERE NOT (SELECT ok FROM ok)""")
def length_quintiles(spark, sf):
    """A5: text-length quintile counts; min/max/mean/upper-median when edges collide."""
    return length_distribution(valid(spark, sf, derive={"v": F.length(blank_to_empty("text"))}), "v")


# ------------------------------------------------------------- dedup -------
@register("fingerprint_dedupe", with_ctes(MCQ, POOL) + """
SELECT "index", dataset, grp, is_first FROM fp""")
def q_fingerprint_dedupe(spark, sf):
    """First occurrence of each case-insensitive fingerprint wins."""
    return deduped_pool(spark, sf).select("index", "dataset", "grp", "is_first")


@register("duplicate_stats", with_ctes(MCQ, POOL) + """,
st AS (SELECT grp, count(*) AS original_count, count(*) FILTER (WHERE NOT is_first) AS duplicate_count,
       count(*) FILTER (WHERE is_first) AS available_count FROM fp GROUP BY grp),
raw AS (SELECT grp, count(*) AS raw_count FROM twins GROUP BY grp)
SELECT raw.grp, raw_count, CAST(coalesce(original_count, 0) AS BIGINT) AS original_count,
  CAST(coalesce(duplicate_count, 0) AS BIGINT) AS duplicate_count,
  CAST(coalesce(available_count, 0) AS BIGINT) AS available_count
FROM raw LEFT JOIN st USING (grp)""")
def q_duplicate_stats(spark, sf):
    """D3 (+ Q12 raw_count): per group raw rows, valid rows, duplicates, available."""
    return duplicate_stats(deduped_pool(spark, sf), raw=with_twins(load_mcq(spark, sf)))


@register("fingerprint_groups", with_ctes(MCQ, POOL) + """
SELECT fp_id, fp_count, source, CAST(length(""" + LOWER_STRIP("text") + """) AS BIGINT) AS text_length,
  CAST(length(""" + LOWER_STRIP("question") + """) AS BIGINT) AS question_length,
  CAST(len(options) AS BIGINT) AS options_count, label, "index"
FROM fp WHERE fp_count > 1""")
def q_fingerprint_groups(spark, sf):
    return fingerprint_groups(deduped_pool(spark, sf))


@register("unique_fingerprints", with_ctes(MCQ, POOL) + """
SELECT count(*) AS total_unique_fingerprints FROM fp WHERE is_first""")
def q_unique_fingerprints(spark, sf):
    return unique_fingerprints(deduped_pool(spark, sf))


@register("incremental_dedupe", with_ctes(MCQ, POOL) + """
SELECT n."index", n.dataset, n.grp FROM fp n
WHERE n.dataset = 'src_twin' AND NOT EXISTS (
  SELECT 1 FROM fp a WHERE a.dataset = 'documents' AND a.fp_id = n.fp_id AND a.fp_count = n.fp_count
    AND """ + LOWER_STRIP("a.text") + " = " + LOWER_STRIP("n.text") + " AND " + LOWER_STRIP("a.question") + " = " +
          LOWER_STRIP("n.question") + """
    AND list_transform(a.options, lambda o: """ + LOWER_STRIP("o") + """) =
        list_transform(n.options, lambda o: """ + LOWER_STRIP("o") + """))""")
def q_incremental_dedupe(spark, sf):
    """Twin rows whose fingerprint is not among the accepted originals."""
    p = deduped_pool(spark, sf)
    new = p.where(F.col("dataset") == "src_twin")
    accepted = p.where(F.col("dataset") == "documents")
    return incremental_dedupe(new, accepted).select("index", "dataset", "grp")


# ------------------------------------------------------------- draws -------
@register("mix_ratio_sample", with_ctes(MCQ, POOL, DRAWN) + """
SELECT "index", dataset, grp FROM drawn""")
def q_mix_ratio_sample(spark, sf):
    """M1: floor(total x ratio) rows per group, uniformly, all when short."""
    return drawn(spark, sf).select("index", "dataset", "grp")


@register("mix_group_targets", with_ctes(MCQ, POOL) + """,
av AS (SELECT grp, count(*) AS available FROM fp WHERE is_first GROUP BY grp)
SELECT g.grp, CAST(floor(""" + TOTAL + """ * g.ratio) AS BIGINT) AS target,
  CAST(coalesce(av.available, 0) AS BIGINT) AS available,
  CAST(least(floor(""" + TOTAL + """ * g.ratio), coalesce(av.available, 0)) AS BIGINT) AS drawn,
  coalesce(av.available, 0) < floor(""" + TOTAL + """ * g.ratio) AS short
FROM groups g LEFT JOIN av USING (grp)""")
def q_mix_group_targets(spark, sf):
    """Per group target, available, drawn, shortage flag."""
    p = deduped_pool(spark, sf).where("is_first")
    return group_targets(p, group_config(spark), mix_total(spark, sf))


@register("stratified_sample", with_ctes(MCQ, CLASSIFIED, VALID) + """,
x AS (SELECT *, len(options) AS opt_count, length(text) AS text_length FROM valid),
e AS (SELECT quantile_cont(text_length, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM x),
b AS (SELECT x.*, source || '_' || CAST(opt_count AS VARCHAR) || '_' || CASE
      WHEN text_length <= q[2] THEN 'very_short' WHEN text_length <= q[3] THEN 'short'
      WHEN text_length <= q[4] THEN 'medium' WHEN text_length <= q[5] THEN 'long' ELSE 'very_long' END AS stratum
    FROM x, e),
s AS (SELECT *, count(*) OVER (PARTITION BY stratum) AS s_n, count(*) OVER () AS n,
    row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || dataset || ':' || CAST("index" AS VARCHAR))) AS rn
  FROM b)
SELECT "index", stratum FROM s
WHERE rn <= floor(floor(n * 0.5::DOUBLE) * (s_n / n))""")
def q_stratified_sample(spark, sf):
    """M2: strata source x option count x length quintile; target = half the rows."""
    v = valid(spark, sf, keep=["index", "dataset", "source"],
              derive={"opt_count": F.size("options"), "text_length": F.length(blank_to_empty("text"))})
    target = v.agg(F.floor(F.count(F.lit(1)) * F.lit(0.5)).alias("t")).select("t").scalar()
    return stratified_sample(v, target).select("index", "stratum")


@register("shuffle_rank", with_ctes(MCQ, CLASSIFIED, VALID) + """
SELECT "index", row_number() OVER (ORDER BY md5('42:' || dataset || ':' || CAST("index" AS VARCHAR))) AS rn
FROM valid""")
def q_shuffle_rank(spark, sf):
    """O1: seeded shuffle position (exact, bucketed, no single-task window)."""
    return with_shuffle_rank(valid(spark, sf, keep=["dataset", "index"]), ["dataset", "index"]).select("index", "rn")


@register("batch_ids", with_ctes(MCQ, CLASSIFIED, VALID) + """
SELECT "index", CAST((row_number() OVER (ORDER BY "index") - 1) // 50 AS BIGINT) AS batch_id FROM valid""")
def q_batch_ids(spark, sf):
    """W1+W3: position in input order, batches of 50 rows."""
    v = valid(spark, sf, keep=["index"])
    r = ranked(v, ["index"], int_bucket(v, "index"), (), "pos", n_buckets=MAX_INT_BUCKETS + 1)
    return r.select("index", F.floor((F.col("pos") - 1) / 50).cast("bigint").alias("batch_id"))


# ----------------------------------------------------- fences / split -------
@register("length_fence", with_ctes(MCQ, CLASSIFIED, VALID, VLEN, FENCE) + """
SELECT round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       round(upper, 6) AS upper FROM fence""")
def q_length_fence(spark, sf):
    """Q1, median, Q3, IQR, upper fence of the total length (exact)."""
    f = fence_stats(valid_len(spark, sf), "length")
    return f.select(*[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "iqr", "upper")])


@register("outlier_filter", with_ctes(MCQ, CLASSIFIED, VALID, VLEN, FENCE, KEPT) + """
SELECT "index", length FROM kept""")
def q_outlier_filter(spark, sf):
    """M4: keep rows with total length <= Q3 + 1.5 IQR."""
    return outlier_filter(valid_len(spark, sf)).select("index", "length")


@register("outliers", with_ctes(MCQ, CLASSIFIED, VALID, VLEN, FENCE) + """
SELECT "index", source, length, CAST(length(text) AS BIGINT) AS text_length,
  CAST(length(question) AS BIGINT) AS question_length,
  CAST(list_sum(list_transform(options, lambda o: length(o))) AS BIGINT) AS options_length
FROM vlen WHERE length > (SELECT upper FROM fence)""")
def q_outliers(spark, sf):
    parts = {n: c for n, c in length_parts().items()}
    return outlier_rows(valid_len(spark, sf, keep=["index", "source"], derive=parts))


@register("outlier_refill", with_ctes(MCQ, POOL, DRAWN) + """,
dl AS (SELECT *, CAST(""" + LEN + """ AS BIGINT) AS length FROM drawn),
gf AS (SELECT grp, q[2] + 1.5 * (q[2] - q[1]) AS upper
       FROM (SELECT grp, quantile_cont(length, [0.25, 0.75]) AS q FROM dl GROUP BY grp)),
need AS (SELECT grp, count(*) FILTER (WHERE length > upper) AS need FROM dl JOIN gf USING (grp) GROUP BY grp),
pl AS (SELECT *, CAST(""" + LEN + """ AS BIGINT) AS length FROM fp WHERE is_first),
pool2 AS (SELECT p.* FROM pl p JOIN gf USING (grp) WHERE p.length <= gf.upper
          AND NOT EXISTS (SELECT 1 FROM drawn d WHERE d.dataset = p.dataset AND d."index" = p."index")),
refill AS (SELECT * FROM (
    SELECT p.*, n.need, row_number() OVER (PARTITION BY p.grp
        ORDER BY md5('42:' || p.dataset || ':' || CAST(p."index" AS VARCHAR))) AS rn
    FROM pool2 p JOIN need n USING (grp)) WHERE rn <= need)
SELECT "index", dataset, grp, false AS refilled FROM dl JOIN gf USING (grp) WHERE length <= upper
UNION ALL SELECT "index", dataset, grp, true FROM refill""")
def q_outlier_refill(spark, sf):
    """M5: per-group fence on the draw, refill from the group's unused in-bound rows."""
    avail = deduped_pool(spark, sf).where("is_first")
    d = materialize(ratio_mix(avail, group_config(spark), mix_total(spark, sf)), "drawn")
    return outlier_refill(d.drop("target"), avail, max_groups=len(GROUP_RATIOS)).select("index", "dataset", "grp", "refilled")


@register("selection_summary", with_ctes(MCQ, POOL, DRAWN) + """,
dl AS (SELECT CAST(""" + LEN + """ AS BIGINT) AS length FROM drawn),
f AS (SELECT q[2] + 1.5 * (q[2] - q[1]) AS upper FROM (SELECT quantile_cont(length, [0.25, 0.75]) AS q FROM dl))
SELECT count(*) AS before, count(*) FILTER (WHERE length > (SELECT upper FROM f)) AS outliers,
       count(*) FILTER (WHERE length <= (SELECT upper FROM f)) AS kept FROM dl""")
def q_selection_summary(spark, sf):
    """Mix size before the fence, outliers, kept."""
    d = outlier_flag(drawn(spark, sf))
    return d.agg(F.count(F.lit(1)).alias("before"), F.count_if("is_outlier").alias("outliers"),
                 F.count_if(~F.col("is_outlier")).alias("kept"))


def split_frame(spark, sf):
    return split_flags(materialize(outlier_filter(valid_len(spark, sf, keep=["index", "dataset", "source"])), "kept"))


@register("split_flags", with_ctes(MCQ, CLASSIFIED, VALID, VLEN, FENCE, KEPT, SPLIT) + """
SELECT "index", rn, is_full, is_peft, is_eval FROM split""")
def q_split_flags(spark, sf):
    """M3: nested split flags after the seeded shuffle."""
    return split_frame(spark, sf).select("index", "rn", "is_full", "is_peft", "is_eval")


@register("split_sizes", with_ctes(MCQ, CLASSIFIED, VALID, VLEN, FENCE, KEPT, SPLIT) + """
SELECT 'eval' AS split, count(*) FILTER (WHERE is_eval) AS n FROM split
UNION ALL SELECT 'full', count(*) FILTER (WHERE is_full) FROM split
UNION ALL SELECT 'peft', count(*) FILTER (WHERE is_peft) FROM split
UNION ALL SELECT 'unassigned', count(*) FILTER (WHERE NOT is_full AND NOT is_eval) FROM split""")
def q_split_sizes(spark, sf):
    s = split_frame(spark, sf)
    a = s.agg(F.count_if("is_eval").alias("eval"), F.count_if("is_full").alias("full"),
              F.count_if("is_peft").alias("peft"),
              F.count_if(~F.col("is_full") & ~F.col("is_eval")).alias("unassigned"))
    return a.select(F.explode(F.array(*[F.struct(F.lit(k).alias("split"), F.col(k).alias("n"))
                                        for k in ("eval", "full", "peft", "unassigned")])).alias("s")
                    ).select("s.split", "s.n")
