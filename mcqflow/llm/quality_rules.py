"""Quality rules by weak supervision (DataFrame and SQL functions only).

Each rule votes good (+1), bad (-1) or abstains (0) on a document.  The votes
of all documents are counted by pattern (at most 3 ** rules patterns),
expectation-maximisation on the counts estimates the share of good documents
and, for each rule, how often it votes good on good and bad on bad documents.
A document is kept if its posterior probability of being good is at least one
half and no base limit is broken.

The statistics pass writes one narrow row a document to the shared folder;
counts, estimates and verdicts read that table.

Defined cases: null text has no words and fails the base limits; very long
texts are taken whole; rows are judged alone, so ties and repeated rows do not
matter; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mcqflow.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
ITERATIONS = 25

# rule: (bad if, good if), SQL over the statistics, the same for both engines; else it abstains
RULES = {
    "length": ("n_words < 10", "n_words >= 60"),
    "symbols": ("10 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    "symbol_share": ("20 * n_symbols > word_chars", "200 * n_symbols <= word_chars"),
    "symbol_ends": ("10 * n_symbol_ends > n_words", "100 * n_symbol_ends <= n_words"),
    "word_length": ("word_chars < 2 * n_words OR word_chars > 14 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    "lines": ("10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0 AND n_lines >= 3"),
    "windows": ("10 * n_repeat_words > n_words", "n_repeat_words = 0 AND n_words >= 20"),
    "capitals": ("10 * n_capitals > 4 * word_chars", "10 * n_capitals < word_chars"),
    "marks": ("4 * n_marks > n_words", "n_marks = 0"),
    "variety": ("5 * n_distinct < n_words", "10 * n_distinct >= 4 * n_words"),
    "sentences": ("n_stops = 0 AND n_words >= 40", "40 * n_stops >= n_words AND 2 * n_stops <= n_words"),
}
# First guess: nine in ten documents are good; a good document breaks a rule
# once in a hundred times, a bad one breaks each rule once in five.
PRIOR, START_GOOD, START_BAD = 0.9, 0.99, 0.2
LOW, HIGH = 0.02, 0.98  # estimates stay inside, so no single vote decides with certainty


def _repeat_words(h: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more."""
    marked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    def positions(s):
        same = lambda e, j: F.get(s, j).getField("h") == e.getField("h")
        return F.sort_array(F.filter(
            F.transform(s, lambda e, i: F.when(F.coalesce(same(e, i - 1), F.lit(False)) | F.coalesce(same(e, i + 1), F.lit(False)), e.getField("p"))),
            lambda p: p.isNotNull()))
    def covered(p):
        return F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                           F.lit(0).cast("long"), lambda a, x: a + x)
    pos = F.element_at(F.transform(F.array(marked), positions), 1)
    full = F.element_at(F.transform(F.array(pos), covered), 1)
    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(full)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    w = F.col("__w")
    df = docs.select(F.col(id_col), text.alias("__t")).withColumn("__k", F.btrim("__t", F.lit(" \t\n\x0b\f\r")))
    df = df.withColumn("__w", F.when(F.col("__k") == "", F.array().cast("array<string>")).otherwise(F.split("__k", SPACE)))
    df = df.withColumn("__h", F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.slice(w, 1, F.greatest(F.size(w) - WINDOW + 1, F.lit(0))),
                    lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]))))
    df = df.withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    long = lambda c: c.cast("long")
    return df.select(
        id_col, long(F.size(w)).alias("n_words"), long(F.char_length(F.array_join(w, ""))).alias("word_chars"),
        long(F.regexp_count("__t", F.lit(r"[#*$%&|<>]"))).alias("n_symbols"),
        long(F.size("__l") - F.size(F.array_distinct("__l"))).alias("n_dup_lines"),
        long(_repeat_words(F.col("__h"))).alias("n_repeat_words"),
        long(F.size("__l")).alias("n_lines"), long(F.size(F.array_distinct(w))).alias("n_distinct"),
        long(F.regexp_count("__t", F.lit(r"\p{Lu}"))).alias("n_capitals"),
        long(F.regexp_count("__t", F.lit("!"))).alias("n_marks"),
        long(F.regexp_count("__t", F.lit(r"[#*$%&|<>][\x20\x09-\x0D]"))).alias("n_symbol_ends"),
        long(F.regexp_count("__t", F.lit(r"[.,;:?]"))).alias("n_stops"))


def votes() -> Column:
    return F.array(*[F.expr(f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END")
                     for bad, good in RULES.values()])


def _posterior(v: Column, m: Column) -> Column:
    """P(good | votes) under the estimates m: prior, good[j], bad[j]."""
    logit = F.log(m["prior"] / (1 - m["prior"]))
    for j in range(len(RULES)):
        a, b, x = m["good"][j], m["bad"][j], v[j]
        logit = logit + F.when(x == 1, F.log(a / (1 - b))).when(x == -1, F.log((1 - a) / b)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-logit))


def _bounded(x: Column) -> Column:
    return F.least(F.lit(HIGH), F.greatest(F.lit(LOW), x))


def estimates(stats: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """One row ``m``: prior, good (P(+1 | good, voted)), bad (P(-1 | bad, voted))."""
    n = len(RULES)
    patterns = (stats.select(votes().alias("v")).groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("c"))
                .agg(F.sort_array(F.collect_list(F.struct("v", "c"))).alias("pats")))  # at most 3 ** rules entries
    start = F.struct(F.lit(PRIOR).alias("prior"), F.array(*[F.lit(START_GOOD)] * n).alias("good"), F.array(*[F.lit(START_BAD)] * n).alias("bad"))
    pats = F.col("pats")

    def total(qs, weight):
        return F.aggregate(qs, F.lit(0.0), lambda s, e: s + weight(e))

    def step(m, _):
        qs = F.transform(pats, lambda p: F.struct(p["v"].alias("v"), (p["c"] * _posterior(p["v"], m)).alias("g"), p["c"].alias("c")))

        def update(q):
            g = total(q, lambda e: e["g"])
            both = total(q, lambda e: e["c"])
            hit = lambda j, side, key: total(q, lambda e: F.when(e["v"][j] == side, key(e)).otherwise(F.lit(0.0)))
            good, bad = [], []
            for j in range(n):
                gp, gn = hit(j, 1, lambda e: e["g"]), hit(j, -1, lambda e: e["g"])
                bp, bn = hit(j, 1, lambda e: e["c"] - e["g"]), hit(j, -1, lambda e: e["c"] - e["g"])
                # one pseudo-vote at the first guess keeps rules without votes defined
                good.append(_bounded((gp + F.lit(START_GOOD)) / (gp + gn + F.lit(1.0))))
                bad.append(_bounded((bn + F.lit(START_BAD)) / (bp + bn + F.lit(1.0))))
            return F.struct(_bounded(F.when(both > 0, g / both).otherwise(F.lit(PRIOR))).alias("prior"),
                            F.array(*good).alias("good"), F.array(*bad).alias("bad"))
        return F.element_at(F.transform(F.array(qs), update), 1)

    return patterns.select(F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, step).alias("m"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, posterior and verdict of every document."""
    stats = materialize(statistics(docs, id_col, text_col), "quality-stats")
    m = materialize(estimates(stats), "quality-model")  # one row
    df = stats.withColumn("m", m.scalar())
    df = df.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    df = df.withColumn("__p", _posterior(votes(), F.col("m")))
    return df.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                     (~F.col("base_failed") & (F.col("__p") >= 0.5)).alias("kept"), F.round("__p", 4).alias("quality_prob"))


def oracle_sql() -> str:
    """The same in DuckDB SQL: plain counts, then the estimates by a recursive query."""
    names = list(RULES)
    cols = ", ".join(f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v{j}" for j, (bad, good) in enumerate(RULES.values()))
    logit = " + ".join(["ln(prior / (1 - prior))"] + [
        f"CASE v{j} WHEN 1 THEN ln(g{j} / (1 - b{j})) WHEN -1 THEN ln((1 - g{j}) / b{j}) ELSE 0 END" for j in range(len(names))])
    clip = lambda x: f"least({HIGH}, greatest({LOW}, {x}))"
    upd = ", ".join(
        clip(f"(coalesce(sum(c * q) FILTER (v{j} = 1), 0) + {START_GOOD}) / (coalesce(sum(c * q) FILTER (v{j} <> 0), 0) + 1)") + f" AS g{j}, "
        + clip(f"(coalesce(sum(c * (1 - q)) FILTER (v{j} = -1), 0) + {START_BAD}) / (coalesce(sum(c * (1 - q)) FILTER (v{j} <> 0), 0) + 1)") + f" AS b{j}"
        for j in range(len(names)))
    vs = ", ".join(f"v{j}" for j in range(len(names)))
    init = ", ".join(f"CAST({START_GOOD} AS DOUBLE) AS g{j}, CAST({START_BAD} AS DOUBLE) AS b{j}" for j in range(len(names)))
    return rf"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
k AS (SELECT doc_id, p, array_to_string(w[p:p+4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM w WHERE len(w) >= 5)),
kr AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS n FROM k) WHERE n > 1),
rw AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM kr) GROUP BY doc_id),
s AS MATERIALIZED (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  len(l) AS n_lines, len(list_distinct(w)) AS n_distinct,
  length(regexp_replace(text, '\P{{Lu}}', '', 'g')) AS n_capitals, length(regexp_replace(text, '[^!]', '', 'g')) AS n_marks,
  length(regexp_replace(text, '[^.,;:?]', '', 'g')) AS n_stops,
  len(regexp_extract_all(text, '[#*$%&|<>][\x20\x09-\x0D]')) AS n_symbol_ends
  FROM w LEFT JOIN rw USING (doc_id)),
v AS MATERIALIZED (SELECT *, {cols} FROM s),
p AS MATERIALIZED (SELECT {vs}, CAST(count(*) AS DOUBLE) AS c FROM v GROUP BY ALL),
em AS (SELECT 0 AS it, CAST({PRIOR} AS DOUBLE) AS prior, {init}
  UNION ALL
  SELECT it + 1, {clip("sum(c * q) / sum(c)")} AS prior, {upd}
  FROM (SELECT p.*, em.it, 1 / (1 + exp(-({logit}))) AS q FROM p, em WHERE em.it < {ITERATIONS}) GROUP BY it),
r AS (SELECT v.*, 1 / (1 + exp(-({logit}))) AS q, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM v, (SELECT * FROM em WHERE it = {ITERATIONS}) AS em)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND q >= 0.5 AS kept, round(q, 4) AS quality_prob FROM r
"""
