"""Queries: label balancing and shuffle-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from mcqflow.operators.balance import balance_labels, balance_report
from mcqflow.operators.stats import (chunk_source_counts, label_optcount_distribution,
                                     share, shuffle_header, shuffle_uniformity, source_trend)
from mcqflow.plans.oracle_sql import CLASSIFIED, MCQ, VALID, with_ctes
from mcqflow.plans.q_clean import valid
from mcqflow.plans.q_mix import FENCE, KEPT, SPLIT, VLEN, split_frame
from mcqflow.plans.registry import register
from mcqflow.session import materialize

BAL = """bal AS (SELECT *, CAST(len(options) AS BIGINT) AS opt_count,
    CAST((row_number() OVER (PARTITION BY len(options) ORDER BY "index") - 1) % len(options) AS BIGINT) AS target
  FROM valid),
balanced AS (SELECT "index", opt_count, target AS label, label AS original_label,
    list_transform(options, lambda o, i: CASE WHEN i - 1 = target THEN options[label + 1]
        WHEN i - 1 = label THEN options[target + 1] ELSE o END) AS options,
    options[label + 1] AS answer_text FROM bal)"""

DIST = """dist_before AS (SELECT *, sum(cnt) OVER (PARTITION BY opt_count) AS total FROM (
    SELECT CAST(len(options) AS BIGINT) AS opt_count, label, count(*) AS cnt FROM valid GROUP BY 1, 2)),
dist_after AS (SELECT *, sum(cnt) OVER (PARTITION BY opt_count) AS total FROM (
    SELECT opt_count, label, count(*) AS cnt FROM balanced GROUP BY 1, 2))"""

FULL = "full_set AS (SELECT *, rn - 1 AS pos FROM split WHERE is_full)"
SHUF = (MCQ, CLASSIFIED, VALID, VLEN, FENCE, KEPT, SPLIT, FULL)


def full_set(spark, sf):
    """The full_train output of the split, positions 0..n-1 in shuffled order."""
    s = split_frame(spark, sf).where("is_full").withColumn("pos", F.col("rn") - 1)
    return materialize(s.select("index", "source", "pos"), "full_set")


@register("balance_labels", with_ctes(MCQ, CLASSIFIED, VALID, BAL) + """
SELECT "index", opt_count, label, original_label, options, options[label + 1] = answer_text AS answer_kept
FROM balanced""")
def q_balance_labels(spark, sf):
    """B1/B2: cyclic target label per option count, right option swapped in."""
    b = balance_labels(valid(spark, sf, keep=["index", "options", "label"]))
    return b.select("index", F.col("opt_count").cast("bigint").alias("opt_count"), "label",
                    "original_label", "options", "answer_kept")


@register("label_distribution", with_ctes(MCQ, CLASSIFIED, VALID) + """
SELECT opt_count, label, cnt AS "count", CAST(sum(cnt) OVER (PARTITION BY opt_count) AS BIGINT) AS total
FROM (SELECT CAST(len(options) AS BIGINT) AS opt_count, label, count(*) AS cnt FROM valid GROUP BY 1, 2)""")
def q_label_distribution(spark, sf):
    """A4: label x option-count counts with the group total."""
    return label_optcount_distribution(valid(spark, sf, keep=["options", "label"]))


@register("balance_report", with_ctes(MCQ, CLASSIFIED, VALID, BAL, DIST) + """
SELECT coalesce(b.opt_count, a.opt_count) AS opt_count, coalesce(b.label, a.label) AS label,
  CAST(coalesce(b.cnt, 0) AS BIGINT) AS before,
  round(coalesce(b.cnt, 0) * 100.0 / max(b.total) OVER (PARTITION BY coalesce(b.opt_count, a.opt_count)), 6) AS before_pct,
  CAST(coalesce(a.cnt, 0) AS BIGINT) AS after,
  round(coalesce(a.cnt, 0) * 100.0 / max(a.total) OVER (PARTITION BY coalesce(b.opt_count, a.opt_count)), 6) AS after_pct
FROM dist_before b FULL OUTER JOIN dist_after a ON a.opt_count = b.opt_count AND a.label = b.label""")
def q_balance_report(spark, sf):
    """before/after label distribution per option count."""
    v = materialize(valid(spark, sf, keep=["index", "options", "label"]), "valid")
    return balance_report(v, balance_labels(v))


@register("chunk_source_counts", with_ctes(*SHUF) + """,
srcs AS (SELECT DISTINCT source FROM full_set),
ch AS (SELECT pos // 100 AS chunk, count(*) AS t FROM full_set GROUP BY 1),
c AS (SELECT pos // 100 AS chunk, source, count(*) AS n FROM full_set GROUP BY 1, 2)
SELECT CAST(ch.chunk AS BIGINT) AS chunk, s.source, CAST(coalesce(c.n, 0) AS BIGINT) AS n,
  round(coalesce(c.n, 0) * 100.0 / ch.t, 6) AS pct
FROM ch JOIN srcs s ON TRUE LEFT JOIN c ON c.chunk = ch.chunk AND c.source = s.source""")
def q_chunk_source_counts(spark, sf):
    """A10: source counts in every chunk of 100 rows (zero cells kept)."""
    return chunk_source_counts(full_set(spark, sf))


@register("shuffle_header", with_ctes(*SHUF) + """
SELECT count(*) AS "rows", CAST(100 AS BIGINT) AS chunk_size, CAST(ceil(count(*) / 100) AS BIGINT) AS chunks,
  count(DISTINCT source) AS sources FROM full_set""")
def q_shuffle_header(spark, sf):
    return shuffle_header(full_set(spark, sf))


_TREND = """,
srcs AS (SELECT DISTINCT source FROM full_set),
nn AS (SELECT count(*) AS n FROM full_set),
wins AS (SELECT unnest(range(0, CAST(@NW AS BIGINT))) AS "window" FROM nn),
c AS (SELECT w."window", f.source, count(*) AS cnt FROM wins w JOIN full_set f
      ON f.pos >= w."window" * @STEP AND f.pos < w."window" * @STEP + 500 GROUP BY 1, 2)
SELECT CAST(w."window" AS BIGINT) AS "window", s.source, round(coalesce(c.cnt, 0) / 5.0, 6) AS avg_per_chunk
FROM wins w JOIN srcs s ON TRUE LEFT JOIN c ON c."window" = w."window" AND c.source = s.source"""


@register("source_trend", with_ctes(*SHUF) + _TREND.replace("@NW", "ceil(n / 500)").replace("@STEP", "500"))
def q_source_trend(spark, sf):
    """Average count per chunk, tumbling windows of 5 chunks."""
    return source_trend(full_set(spark, sf))


@register("source_trend_sliding", with_ctes(*SHUF) + _TREND.replace("@NW", "ceil(n / 100)")
          .replace("@STEP", "100"))
def q_source_trend_sliding(spark, sf):
    """A11 sliding: windows of 5 chunks that start at every chunk."""
    return source_trend(full_set(spark, sf), stride=100)


@register("shuffle_uniformity", with_ctes(*SHUF) + """,
c AS (SELECT source, count(*) AS n FROM full_set GROUP BY source)
SELECT round(stddev_samp(n), 6) AS std, round(avg(n), 6) AS mean, round(stddev_samp(n) / avg(n), 6) AS cv,
  stddev_samp(n) / avg(n) < 0.5 AS good FROM c""")
def q_shuffle_uniformity(spark, sf):
    """Std and coefficient of variation of per-source counts."""
    return shuffle_uniformity(full_set(spark, sf))


@register("source_share", with_ctes(*SHUF) + """
SELECT source, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM full_set), 6) AS pct
FROM full_set GROUP BY source""")
def q_source_share(spark, sf):
    """Source share of the output."""
    return share(full_set(spark, sf), "source")


@register("balanced_output", with_ctes(MCQ, CLASSIFIED, VALID, BAL) + """
SELECT "index", label, options FROM balanced""")
def q_balanced_output(spark, sf):
    """K3: the balanced set written as balanced_<name> JSON lines and read back."""
    from mcqflow.session import scratch_path
    from mcqflow.sources.sinks import save_balanced
    p = save_balanced(balance_labels(valid(spark, sf)), scratch_path(spark, "balanced"), "documents")
    return spark.read.schema("index bigint, label bigint, options array<string>").json(p)
