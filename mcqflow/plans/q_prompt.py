"""Queries: prompt rendering, payloads, chat transcripts, prompt-length analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from mcqflow.functions.prompt import (char_length, chat_transcript, prompt_analysis_style,
                                      prompt_json_style, prompt_length_style, prompt_steps_style,
                                      regex_token_length, request_payload)
from mcqflow.operators.sample import length_percentiles
from mcqflow.operators.stats import (box_stats, bucket_shares, counts, histogram, length_bucket,
                                     overall_length_stats, per_dataset_length_stats)
from mcqflow.plans.oracle_sql import CLASSIFIED, MCQ, STRIP, VALID, with_ctes
from mcqflow.plans.q_clean import valid
from mcqflow.plans.registry import register
from mcqflow.session import materialize
from mcqflow.sources.fixtures import read_table

NL = "chr(10)"


def OPTBLOCK(o="options"):
    return f"array_to_string(list_transform({o}, lambda x, i: chr(CAST(64 + i AS INTEGER)) || '. ' || x), {NL})"


def OPTINLINE(o="options"):
    return f"array_to_string(list_transform({o}, lambda x, i: '(' || chr(CAST(64 + i AS INTEGER)) || ') ' || x), ' ')"


P_LENGTH = (f"coalesce(text, '') || {NL} || 'Question: ' || coalesce(question, '') || {NL} || "
            f"{OPTBLOCK()} || {NL} || 'Answer:'")
P_STEPS = (f"coalesce(text, '') || {NL} || 'Question: ' || coalesce(question, '') || {NL} || 'Options:' || {NL} || "
           f"{OPTBLOCK()} || {NL} || 'Answer:' || {NL} || "
           "'Take a deep breath and work on this problem step-by-step.'")
P_JSON = (f"'Text: ' || coalesce(text, '') || {NL} || 'Question: ' || coalesce(question, '') || {NL} || "
          f"'Options:' || {NL} || {OPTBLOCK()}")
P_ANALYSIS = (f"CASE WHEN {STRIP('text')} <> '' THEN {STRIP('text')} || {NL} || {NL} ELSE '' END || "
              f"CASE WHEN {STRIP('question')} <> '' THEN {STRIP('question')} || {NL} ELSE '' END || "
              f"{NL} || 'Options: ' || {OPTINLINE()} || {NL} || {NL} || 'Let''s think step by step:'")

# Parameters of the request payload query (our own short system prompt).
SYSTEM_PROMPT = "Answer the single-choice question. End with 'The answer is: (X)'."
MODEL = "reasoning-model"

LENGTHS = ("lengths AS (SELECT coalesce(source, 'unknown') AS dataset, CAST(length(" + P_LENGTH + ") AS BIGINT) AS length FROM valid)")
LBASE = (MCQ, CLASSIFIED, VALID, LENGTHS)


def lengths(spark, sf, measure=char_length):
    """(dataset, length) of the rendered length-analysis prompt."""
    v = valid(spark, sf, keep=["source"], derive={"length": measure(prompt_length_style())})
    return materialize(v.select(F.coalesce("source", F.lit("unknown")).alias("dataset"), "length"), "lengths")


def _prompt_query(style):
    def q(spark, sf):
        return valid(spark, sf).select("index", style().alias("prompt"))
    return q


for _name, _style, _sql in (("prompt_render_length", prompt_length_style, P_LENGTH),
                            ("prompt_render_steps", prompt_steps_style, P_STEPS),
                            ("prompt_render_json", prompt_json_style, P_JSON),
                            ("prompt_render_analysis", prompt_analysis_style, P_ANALYSIS)):
    register(_name, with_ctes(MCQ, CLASSIFIED, VALID) + f'SELECT "index", {_sql} AS prompt FROM valid')(
        _prompt_query(_style))


@register("prompt_token_length", with_ctes(MCQ, CLASSIFIED, VALID) + f"""
SELECT "index", CAST(len(regexp_extract_all({P_LENGTH}, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+|[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s]')) AS BIGINT) AS tokens FROM valid""")
def q_prompt_token_length(spark, sf):
    """P21 with the built-in regex token measure."""
    return valid(spark, sf, keep=["index"], derive={"tokens": regex_token_length(prompt_length_style())}).select("index", "tokens")


@register("request_payload", with_ctes(MCQ, CLASSIFIED, VALID) + f"""
SELECT "index", to_json({{'model': '{MODEL}', 'messages': [{{'role': 'system', 'content': '{SYSTEM_PROMPT.replace("'", "''")}'}},
  {{'role': 'user', 'content': {P_STEPS}}}], 'temperature': 0.3::DOUBLE, 'max_tokens': 1000}})::VARCHAR AS payload
FROM valid""")
def q_request_payload(spark, sf):
    """Chat request body per row (system + user message)."""
    return valid(spark, sf).select("index", request_payload(
        prompt_steps_style(), SYSTEM_PROMPT, MODEL, 0.3, 1000).alias("payload"))


@register("chat_template", """
SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), ''
  ORDER BY turn) || '<|im_start|>assistant' || chr(10) AS transcript
FROM conversations GROUP BY conv_id""")
def q_chat_template(spark, sf):
    """Conversations rendered with the chat template."""
    return chat_transcript(read_table(spark, sf, "conversations"))


# ---------------------------------------------------- length analysis ------
@register("length_overall", with_ctes(*LBASE) + """
SELECT count(*) AS n, count(DISTINCT dataset) AS datasets, min(length) AS min, max(length) AS max,
  round(avg(length), 6) AS mean, round(quantile_cont(length, 0.5), 6) AS median FROM lengths""")
def q_length_overall(spark, sf):
    """Overall prompt-length statistics."""
    return overall_length_stats(lengths(spark, sf))


@register("length_by_dataset", with_ctes(*LBASE) + """
SELECT dataset, count(*) AS n, min(length) AS min, max(length) AS max, round(avg(length), 6) AS mean,
  round(quantile_cont(length, 0.5), 6) AS median, round(stddev_samp(length), 6) AS std,
  round(quantile_cont(length, 0.25), 6) AS q1, round(quantile_cont(length, 0.75), 6) AS q3
FROM lengths GROUP BY dataset""")
def q_length_by_dataset(spark, sf):
    """Per-dataset prompt-length statistics."""
    return per_dataset_length_stats(lengths(spark, sf))


BUCKET_SQL = """CASE WHEN length < 500 THEN '0-500' WHEN length < 1000 THEN '501-1000'
  WHEN length < 2000 THEN '1001-2000' WHEN length < 5000 THEN '2001-5000' ELSE '5000+' END"""


@register("length_buckets", with_ctes(*LBASE) + f""",
b AS (SELECT dataset, {BUCKET_SQL} AS bucket FROM lengths)
SELECT dataset, bucket, count(*) AS n,
  round(count(*) * 100.0 / (SELECT count(*) FROM b b2 WHERE b2.dataset = b.dataset), 6) AS pct
FROM b GROUP BY dataset, bucket
UNION ALL
SELECT 'ALL', bucket, count(*), round(count(*) * 100.0 / (SELECT count(*) FROM b), 6) FROM b GROUP BY bucket""")
def q_length_buckets(spark, sf):
    """Share of fixed length buckets per dataset and overall."""
    return bucket_shares(lengths(spark, sf))


@register("composition", with_ctes(*LBASE) + """
SELECT dataset, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM lengths), 6) AS pct
FROM lengths GROUP BY dataset
UNION ALL SELECT 'TOTAL', count(*), 100.0 FROM lengths""")
def q_composition(spark, sf):
    """Dataset composition with a total row."""
    from mcqflow.operators.stats import share
    ln = lengths(spark, sf)
    s = share(ln, "dataset")
    total = ln.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("TOTAL").alias("dataset"), "n", F.lit(100.0).alias("pct"))
    return s.unionByName(total)


@register("box_stats", with_ctes(*LBASE) + """,
q AS (SELECT dataset, quantile_cont(length, 0.25) AS q1, quantile_cont(length, 0.5) AS median,
    quantile_cont(length, 0.75) AS q3 FROM lengths GROUP BY dataset),
x AS (SELECT l.*, q.q1, q.median, q.q3, l.length >= q.q1 - 1.5 * (q.q3 - q.q1)
    AND l.length <= q.q3 + 1.5 * (q.q3 - q.q1) AS inside FROM lengths l JOIN q USING (dataset))
SELECT dataset, round(any_value(median), 6) AS median, round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3,
  min(length) FILTER (WHERE inside) AS whisker_lo, max(length) FILTER (WHERE inside) AS whisker_hi,
  count(*) FILTER (WHERE NOT inside) AS fliers FROM x GROUP BY dataset""")
def q_box_stats(spark, sf):
    """The numbers behind a per-dataset box plot."""
    return box_stats(lengths(spark, sf))


@register("split_by_median", with_ctes(*LBASE) + """,
m AS (SELECT dataset, quantile_cont(length, 0.5) AS median FROM lengths GROUP BY dataset)
SELECT dataset, round(median, 6) AS median,
  CASE WHEN median <= (SELECT quantile_cont(median, 0.5) FROM m) THEN 'short' ELSE 'long' END AS part FROM m""")
def q_split_by_median(spark, sf):
    """Datasets with median <= the median of medians are 'short'."""
    m = length_percentiles(lengths(spark, sf), "length", [0.5], ["dataset"]).select(
        "dataset", F.col("q")[0].alias("median"))
    m = materialize(m, "medians")
    thr = m.agg(F.percentile("median", F.lit(0.5)).alias("t")).select("t").scalar()
    return m.select("dataset", F.round("median", 6).alias("median"),
                    F.when(F.col("median") <= thr, "short").otherwise("long").alias("part"))


def _hist_sql(lo, hi, n_edges, where):
    nb = n_edges - 1
    return f""",
r AS (SELECT CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi FROM lengths LIMIT 1),
x AS (SELECT l.dataset, CAST(l.length AS DOUBLE) AS v, r.lo, r.hi FROM lengths l, r WHERE {where})
SELECT dataset, CAST(CASE WHEN v = hi THEN {nb - 1} ELSE floor((v - lo) * ({nb} / (hi - lo))) END AS BIGINT) AS bin,
  count(*) AS n FROM x GROUP BY 1, 2"""


@register("hist_tail", with_ctes(*LBASE) + _hist_sql(
    "(SELECT quantile_cont(length, 0.95) FROM lengths)", "(SELECT max(length) FROM lengths)", 20,
    "CAST(l.length AS DOUBLE) > r.lo AND CAST(l.length AS DOUBLE) <= r.hi"))
def q_hist_tail(spark, sf):
    """Tail histogram, lengths above p95 in 20 edges from p95 to max."""
    ln = lengths(spark, sf)
    lo = length_percentiles(ln, "length", [0.95]).select(F.col("q")[0]).scalar()
    hi = ln.agg(F.max("length").cast("double")).scalar()
    return histogram(ln.where(F.col("length") > lo), "length", lo, hi, 20, ["dataset"])


@register("hist_stacked", with_ctes(*LBASE) + _hist_sql(
    "0", "(SELECT quantile_cont(length, 0.99) FROM lengths)", 40,
    "CAST(l.length AS DOUBLE) >= r.lo AND CAST(l.length AS DOUBLE) <= r.hi"))
def q_hist_stacked(spark, sf):
    """Stacked histogram, 40 edges from 0 to p99 (values above dropped)."""
    ln = lengths(spark, sf)
    hi = length_percentiles(ln, "length", [0.99]).select(F.col("q")[0]).scalar()
    return histogram(ln, "length", F.lit(0.0), hi, 40, ["dataset"])


@register("nested_composition", with_ctes(*LBASE) + f"""
SELECT dataset, {BUCKET_SQL} AS bucket, count(*) AS n FROM lengths GROUP BY 1, 2""")
def q_nested_composition(spark, sf):
    """Non-zero (dataset, length bucket) counts."""
    ln = lengths(spark, sf)
    return counts(ln.withColumn("bucket", length_bucket(F.col("length"))), "dataset", "bucket")


@register("dataset_order", with_ctes(*LBASE) + """
SELECT dataset, round(median, 6) AS median, CAST(row_number() OVER (ORDER BY median, dataset) AS BIGINT) AS rank
FROM (SELECT dataset, quantile_cont(length, 0.5) AS median FROM lengths GROUP BY dataset)""")
def q_dataset_order(spark, sf):
    """O3: datasets ordered by median prompt length (stacked-histogram order)."""
    from mcqflow.operators.stats import order_by_median
    return order_by_median(lengths(spark, sf))


@register("chat_template_request", with_ctes(MCQ, CLASSIFIED, VALID) + f"""
SELECT "index", '<|im_start|>system' || chr(10) || '{SYSTEM_PROMPT.replace("'", "''")}' || '<|im_end|>' || chr(10) ||
  '<|im_start|>user' || chr(10) || {P_STEPS} || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)
  AS rendered FROM valid""")
def q_chat_template_request(spark, sf):
    """P11 + P12: each row's system + user messages rendered with the chat template."""
    from mcqflow.functions.prompt import messages, render_messages
    return valid(spark, sf).select("index", render_messages(messages(SYSTEM_PROMPT, prompt_steps_style()))
                                   .alias("rendered"))


@register("kde_grid", with_ctes(*LBASE) + """,
kx AS (SELECT dataset, length FROM lengths WHERE length <= (SELECT quantile_cont(length, 0.95) FROM lengths)),
st AS (SELECT dataset, count(*) AS n, stddev_samp(length) AS sd, min(length)::DOUBLE AS mn, max(length)::DOUBLE AS mx
       FROM kx GROUP BY dataset HAVING count(*) >= 2 AND stddev_samp(length) > 0),
p AS (SELECT *, sd * pow(n, -0.2) AS h FROM st),
p2 AS (SELECT *, mn - 3.0 * h AS lo, mx + 3.0 * h AS hi, ((mx + 3.0 * h) - (mn - 3.0 * h)) / 199 AS step FROM p),
hist AS (SELECT dataset, length::DOUBLE AS v, count(*) AS c FROM kx GROUP BY 1, 2),
grid AS (SELECT p2.*, g.gi, CASE WHEN g.gi = 199 THEN hi ELSE lo + g.gi * step END AS xg
         FROM p2, (SELECT unnest(range(0, 200)) AS gi) g)
SELECT grid.dataset, CAST(gi AS BIGINT) AS gi, round(xg, 6) AS x,
  round(sum(c * exp(-0.5 * pow((xg - v) / h, 2))) / (n * h * sqrt(2 * pi())) * 1e6, 6) AS density_e6
FROM grid JOIN hist USING (dataset) GROUP BY grid.dataset, gi, xg, n, h""")
def q_kde_grid(spark, sf):
    """Density curve per dataset for lengths <= the overall p95."""
    from mcqflow.operators.stats import kde_grid
    ln = lengths(spark, sf)
    p95 = length_percentiles(ln, "length", [0.95]).select(F.col("q")[0]).scalar()
    return kde_grid(ln, upper=p95)
