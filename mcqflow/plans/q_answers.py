"""Queries: answer extraction, answer checks, reasoning validation, accuracy."""

from __future__ import annotations

from pyspark.sql import functions as F

from mcqflow.functions.answers import (CONCLUSION_MARKERS, STEP_COUNT_PATTERNS, STEP_MARKERS,
                                       answer_correct, answer_patterns, exact_answer_correct,
                                       extract_answer, has_conclusion, has_fields,
                                       has_step_marker, json_answer_correct, step_count)
from mcqflow.operators.reasoning import accuracy_by_type, index_slice, pair_responses, validation_stats
from mcqflow.plans.oracle_sql import MCQ, STRIP, with_ctes
from mcqflow.plans.registry import register
from mcqflow.schema import REASONING_FIELDS, REASONING_STRUCT
from mcqflow.sources.fixtures import (load_mcq, read_table, recorded_responses, with_analysis,
                                      with_json_response, with_reasoning)


def _sq(s: str) -> str:
    return s.replace("'", "''")


def extract_sql(t: str, letters: str = "ABCD", cushion: bool = True) -> str:
    ts = STRIP(f"coalesce({t}, '')")
    parts = []
    for p in answer_patterns(letters, cushion):
        g = f"regexp_extract({ts}, '(?s){_sq(p)}', 1)"
        parts.append("CASE " + " ".join(f"WHEN contains({g}, '{ch}') THEN '{ch}'" for ch in letters) + " END")
    return "coalesce(" + ", ".join(parts) + ", '')"


def any_sql(t: str, pats) -> str:
    return "(" + " OR ".join(f"regexp_matches(coalesce({t}, ''), '{_sq(p)}')" for p in pats) + ")"


def count_sql(t: str, pats) -> str:
    return "CAST(" + " + ".join(f"len(regexp_extract_all(coalesce({t}, ''), '{_sq(p)}'))" for p in pats) + " AS BIGINT)"


REASONING = """reasoning AS (SELECT *, CASE "index" % 12
    WHEN 0 THEN 'First, read the passage. Second, compare. Therefore, the answer is: (' || L || ') ok'
    WHEN 1 THEN 'Step 1: read. Step 2: decide. ANSWER: ' || L
    WHEN 2 THEN 'the correct answer is: \\boxed{' || L || '}'
    WHEN 3 THEN 'Thus the correct option is: so boxed{' || L || '}'
    WHEN 4 THEN 'answer: ' || lower(L)
    WHEN 5 THEN '1. ' || L
    WHEN 6 THEN '首先看文。所以答案是 ' || L || '。'
    WHEN 7 THEN 'no conclusion here'
    WHEN 8 THEN 'the answer is: (' || W || ')'
    WHEN 9 THEN ''
    WHEN 10 THEN 'first think. ' || L || ': because'
    ELSE 'the answer is Although ' || L END AS reasoning
  FROM (SELECT *, CASE WHEN label BETWEEN 0 AND 4 THEN chr(CAST(65 + label AS INTEGER)) ELSE 'A' END AS L,
      CASE WHEN label BETWEEN 1 AND 4 THEN 'A' ELSE 'B' END AS W FROM mcq))"""

ANALYSIS = """analysis AS (SELECT *, CASE WHEN "index" % 10 <> 9 THEN
      CASE WHEN "index" % 4 <> 0 THEN chr(CAST(65 + label AS INTEGER)) WHEN label = 0 THEN 'B' ELSE 'A' END END
      AS correct_answer,
    CASE WHEN "index" % 10 <> 9 THEN ['Deductive', 'Sequential', 'Causal'][CAST("index" % 3 AS INTEGER) + 1] END
      AS reasoning_type
  FROM mcq)"""

JSONRESP = """jresp AS (SELECT *,
    "index" % 10 <> 9 AS answered,
    "index" % 10 <> 9 AND "index" % 9 <> 0 AS has_all,
    CASE WHEN "index" % 10 = 9 THEN NULL WHEN "index" % 4 = 0 THEN (CASE WHEN label BETWEEN 1 AND 4 THEN 'A' ELSE 'B' END)
         WHEN "index" % 4 = 1 THEN ' ' || lower(L) || ' '
         ELSE L END AS answer
  FROM (SELECT *, CASE WHEN label BETWEEN 0 AND 4 THEN chr(CAST(65 + label AS INTEGER)) ELSE 'A' END AS L FROM mcq))"""

R = "reasoning"


def reasoning(spark, sf):
    return with_reasoning(load_mcq(spark, sf))


@register("extract_answer", with_ctes(MCQ, REASONING) + f"""
SELECT "index", {extract_sql(R)} AS letter FROM reasoning""")
def q_extract_answer(spark, sf):
    """Extracted letter (ABCD) from the reasoning text."""
    return reasoning(spark, sf).select("index", extract_answer(R).alias("letter"))


@register("extract_answer_noise", f"""
SELECT 'documents' AS tbl, doc_id AS id, CAST(0 AS BIGINT) AS sub, {extract_sql('text')} AS letter FROM documents
UNION ALL SELECT 'conversations', conv_id, turn, {extract_sql('text')} FROM conversations
UNION ALL SELECT 'pages', page_id, CAST(0 AS BIGINT), {extract_sql('html')} FROM pages""")
def q_extract_answer_noise(spark, sf):
    """P13 over real text: documents, conversation turns and raw pages."""
    d = read_table(spark, sf, "documents").select(F.lit("documents").alias("tbl"), F.col("doc_id").alias("id"),
                                                  F.lit(0).cast("bigint").alias("sub"),
                                                  extract_answer("text").alias("letter"))
    c = read_table(spark, sf, "conversations").select(F.lit("conversations").alias("tbl"),
                                                      F.col("conv_id").alias("id"), F.col("turn").alias("sub"),
                                                      extract_answer("text").alias("letter"))
    p = read_table(spark, sf, "pages").select(F.lit("pages").alias("tbl"), F.col("page_id").alias("id"),
                                              F.lit(0).cast("bigint").alias("sub"),
                                              extract_answer("html").alias("letter"))
    return d.unionByName(c).unionByName(p)


def _check(letters):
    def q(spark, sf):
        x = reasoning(spark, sf).withColumn("extracted", extract_answer(R, letters))
        return x.select("index", "extracted", answer_correct(F.col("extracted"), F.col("label")).alias("correct"))
    return q


for _name, _letters in (("answer_check_abcd", "ABCD"), ("answer_check_abcdef", "ABCDEF")):
    register(_name, with_ctes(MCQ, REASONING) + f"""
SELECT "index", extracted, extracted <> '' AND ascii(extracted) - 65 = label AS correct
FROM (SELECT *, {extract_sql(R, _letters)} AS extracted FROM reasoning)""")(_check(_letters))


@register("answer_check_json", with_ctes(MCQ, JSONRESP) + f"""
SELECT "index", coalesce(upper({STRIP('answer')}) = chr(CAST(65 + label AS INTEGER)), false) AS correct FROM jresp""")
def q_answer_check_json(spark, sf):
    """Structured response answer, stripped and upper-cased, vs label."""
    x = with_json_response(load_mcq(spark, sf))
    ans = F.from_json("response", REASONING_STRUCT)["answer"]
    return x.select("index", json_answer_correct(ans, F.col("label")).alias("correct"))


@register("answer_check_exact", with_ctes(MCQ, ANALYSIS) + """
SELECT "index", coalesce(correct_answer = chr(CAST(65 + label AS INTEGER)), false) AS correct FROM analysis""")
def q_answer_check_exact(spark, sf):
    """P14d: analysis response answer, exact equality; missing = wrong."""
    x = with_analysis(load_mcq(spark, sf))
    ans = F.get_json_object("response", "$.correct_answer")
    return x.select("index", exact_answer_correct(ans, F.col("label")).alias("correct"))


@register("json_response_check", with_ctes(MCQ, JSONRESP) + """
SELECT "index", has_all,
  CASE WHEN NOT answered THEN 'manual_review' WHEN NOT has_all THEN 'retry'
       WHEN upper(""" + STRIP("answer") + """) = chr(CAST(65 + label AS INTEGER)) THEN 'ok' ELSE 'retry' END AS status
FROM jresp""")
def q_json_response_check(spark, sf):
    """P20 + P14c: all seven fields present (as keys), then the answer."""
    x = with_json_response(load_mcq(spark, sf))
    ok_fields = has_fields(F.col("response"), REASONING_FIELDS)
    ans = F.get_json_object("response", "$.answer")
    status = (F.when(F.col("response").isNull(), "manual_review").when(~ok_fields, "retry")
              .when(json_answer_correct(ans, F.col("label")), "ok").otherwise("retry"))
    return x.select("index", ok_fields.alias("has_all"), status.alias("status"))


@register("step_markers", with_ctes(MCQ, REASONING) + f"""
SELECT "index", {any_sql(R, STEP_MARKERS)} AS has_step, {any_sql(R, CONCLUSION_MARKERS)} AS has_conclusion
FROM reasoning""")
def q_step_markers(spark, sf):
    """Step-by-step and conclusion markers."""
    r = reasoning(spark, sf)
    return r.select("index", has_step_marker(F.col(R)).alias("has_step"),
                    has_conclusion(F.col(R)).alias("has_conclusion"))


@register("step_count", with_ctes(MCQ, REASONING) + f"""
SELECT "index", {count_sql(R, STEP_COUNT_PATTERNS)} AS steps FROM reasoning""")
def q_step_count(spark, sf):
    """Number of step mentions (sum over patterns)."""
    return reasoning(spark, sf).select("index", step_count(F.col(R)).alias("steps"))


PROBLEMS_SQL = f"""probs AS (SELECT "index", label, reasoning,
    list_filter([CASE WHEN length(reasoning) < 0 THEN 'too_short' WHEN length(reasoning) > 200000 THEN 'too_long' END,
       CASE WHEN NOT (x <> '' AND ascii(x) - 65 = label) THEN 'answer_wrong' END,
       CASE WHEN {count_sql(R, STEP_COUNT_PATTERNS)} < 0 THEN 'too_few_steps' END,
       CASE WHEN NOT {any_sql(R, STEP_MARKERS)} THEN 'no_step_marker' END,
       CASE WHEN NOT {any_sql(R, CONCLUSION_MARKERS)} THEN 'no_conclusion' END], lambda p: p IS NOT NULL) AS problems,
    x <> '' AND ascii(x) - 65 = label AS answer_correct,
    {any_sql(R, STEP_MARKERS)} AS has_step, {any_sql(R, CONCLUSION_MARKERS)} AS has_conclusion
  FROM (SELECT *, {extract_sql(R, 'ABCDEF')} AS x FROM reasoning))"""


@register("reasoning_problems", with_ctes(MCQ, REASONING, PROBLEMS_SQL) + """
SELECT "index", problems, len(problems) = 0 AS valid FROM probs""")
def q_reasoning_problems(spark, sf):
    """Problem list per row; valid iff empty."""
    from mcqflow.functions.answers import reasoning_problems
    r = reasoning(spark, sf).withColumn("problems", reasoning_problems(F.col(R), F.col("label")))
    return r.select("index", "problems", (F.size("problems") == 0).alias("valid"))


@register("validation_stats", with_ctes(MCQ, REASONING, PROBLEMS_SQL) + """
SELECT count(*) AS total, count(*) FILTER (WHERE len(problems) = 0) AS valid_samples,
  count(*) FILTER (WHERE answer_correct) AS answer_correct,
  count(*) FILTER (WHERE has_step) AS has_step_by_step, count(*) FILTER (WHERE has_conclusion) AS has_conclusion,
  count(*) FILTER (WHERE len(problems) > 0) AS invalid_samples,
  round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE len(problems) = 0) * 100.0 / count(*) END, 6) AS valid_rate,
  round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE has_step) * 100.0 / count(*) END, 6) AS step_rate,
  round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE has_conclusion) * 100.0 / count(*) END, 6) AS conclusion_rate
FROM probs""")
def q_validation_stats(spark, sf):
    """Validation totals and rates (NULL rate on empty input)."""
    return validation_stats(reasoning(spark, sf))


@register("accuracy_by_type", with_ctes(MCQ, ANALYSIS) + """,
a AS (SELECT *, coalesce(correct_answer = chr(CAST(65 + label AS INTEGER)), false) AS is_correct FROM analysis)
SELECT 'ALL' AS reasoning_type, count(*) AS n, count(*) FILTER (WHERE is_correct) AS correct,
  round(count(*) FILTER (WHERE is_correct) * 1.0 / count(*), 6) AS accuracy FROM a
UNION ALL
SELECT reasoning_type, count(*), count(*) FILTER (WHERE is_correct),
  round(count(*) FILTER (WHERE is_correct) * 1.0 / count(*), 6) FROM a
WHERE correct_answer IS NOT NULL GROUP BY reasoning_type""")
def q_accuracy_by_type(spark, sf):
    """Accuracy over all rows, and per reasoning type over answered rows."""
    x = with_analysis(load_mcq(spark, sf))
    x = x.withColumn("correct_answer", F.get_json_object("response", "$.correct_answer")) \
         .withColumn("reasoning_type", F.get_json_object("response", "$.reasoning_type"))
    return accuracy_by_type(x)


@register("offline_evaluation", with_ctes(MCQ, REASONING) + f""",
resp AS (SELECT "index" AS i, 1 AS attempt, reasoning AS response FROM reasoning WHERE "index" % 11 <> 0
  UNION ALL SELECT "index", 0, 'ANSWER: A' FROM reasoning WHERE "index" % 11 <> 0 AND "index" % 7 = 0
  UNION ALL SELECT -"index" - 1, 0, reasoning FROM reasoning WHERE "index" % 13 = 0),
last AS (SELECT i, response FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY attempt DESC) AS n FROM resp) WHERE n = 1),
paired AS (SELECT coalesce(m."index", i) AS "index", label,
    CASE WHEN m."index" IS NULL THEN 'extra' WHEN i IS NULL THEN 'missing' ELSE 'paired' END AS pair_status,
    {extract_sql('response')} AS letter
  FROM mcq m FULL OUTER JOIN last ON m."index" = i)
SELECT "index", pair_status, letter, coalesce(letter <> '' AND ascii(letter) - 65 = label, false) AS correct FROM paired""")
def q_offline_evaluation(spark, sf):
    """Requests joined with separately recorded responses on ``index``."""
    m = load_mcq(spark, sf)
    x = pair_responses(m.select("index", "label"), recorded_responses(m))
    letter = extract_answer("response")
    return x.select("index", "pair_status", letter.alias("letter"),
                    F.coalesce(answer_correct(letter, F.col("label")), F.lit(False)).alias("correct"))


@register("index_slice", with_ctes(MCQ) + """
SELECT "index", pos, pos - 100 AS slice_index FROM (
  SELECT "index", CAST(row_number() OVER (ORDER BY "index") - 1 AS BIGINT) AS pos FROM mcq) WHERE pos >= 100""")
def q_index_slice(spark, sf):
    """Rows [start, end) by input position (end NULL = to the end)."""
    return index_slice(load_mcq(spark, sf), 100, None).select("index", "pos", "slice_index")
