"""Queries: batch generation with an in-process stub model (rows-only checks).

The stub stands in for a remote model: it answers from the payload alone
(md5 of payload and attempt picks a letter), so some rows are right on the
first attempt, some after a retry, some never.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from mcqflow.operators.dedup import numbered
from mcqflow.operators.journal import ResponseJournal
from mcqflow.operators.reasoning import (analysis_run, generate_reasoning, generate_structured,
                                         status_counts)
from mcqflow.plans.oracle_sql import CLASSIFIED, MCQ, VALID, with_ctes
from mcqflow.plans.q_clean import valid
from mcqflow.plans.q_prompt import P_ANALYSIS, P_JSON, P_STEPS
from mcqflow.plans.registry import register

SYSTEM = "Solve the single-choice question step by step."


def _pick(payload: str, attempt: int, n: int = 4) -> str:
    h = int(hashlib.md5(f"{attempt}:{payload}".encode()).hexdigest()[:8], 16)
    return "ABCDE"[h % n]


def _body(content: str) -> str:
    """A chat-completions response body around ``content``."""
    return json.dumps({"choices": [{"index": 0, "message": {"role": "assistant", "content": content}}]})


def stub_text_model(payload: str, attempt: int) -> str:
    return _body(f"First, compare the options. Therefore, the answer is: ({_pick(payload, attempt)})")


def stub_json_model(payload: str, attempt: int) -> str:
    body = {"reasoning_type": "deductive", "given_facts": ["f"], "logical_steps": ["s1", "s2"],
            "conclusion": "c", "answer": _pick(payload, attempt), "confidence": "high"}
    if attempt > 1 or int(hashlib.md5(payload.encode()).hexdigest()[:2], 16) % 5:
        body["reasoning_pattern"] = "elimination"
    return _body(json.dumps(body))


def stub_analysis_model(payload: str, attempt: int) -> str:
    h = int(hashlib.md5(payload.encode()).hexdigest()[:8], 16)
    if h % 10 == 9:
        raise TimeoutError("no response")
    return _body(json.dumps({"reasoning_process": ["read"], "correct_answer": _pick(payload, attempt),
                             "difficulty_level": "easy", "question_type": "choice",
                             "reasoning_type": ["Deductive", "Sequential", "Causal"][h % 3], "is_valid": True}))


def _payload_sql(user: str, temperature: str, max_tokens: int, json_object: bool) -> str:
    rf = ", 'response_format': {'type': 'json_object'}" if json_object else ""
    return (f"to_json({{'model': 'model', 'messages': [{{'role': 'system', 'content': '{SYSTEM}'}}, "
            f"{{'role': 'user', 'content': {user}}}], 'temperature': {temperature}::DOUBLE, "
            f"'max_tokens': {max_tokens}{rf}}})::VARCHAR")


def _pick_sql(attempt_prefix: str, payload: str = "payload", n: int = 4) -> str:
    return (f"substr('ABCDE', CAST((('0x' || substr(md5({attempt_prefix} || {payload}), 1, 8))::BIGINT % {n}) "
            f"AS INTEGER) + 1, 1)")


GEN = ("gen AS (SELECT *, " + ", ".join(f"{_pick_sql(repr(f'{k}:'))} AS l{k}" for k in (1, 2, 3)) +
       " FROM (SELECT *, " + _payload_sql(P_STEPS, "0.7", 2000, False) + " AS payload FROM valid)),\n"
       "gen2 AS (SELECT *, chr(CAST(65 + label AS INTEGER)) AS lab FROM gen),\n"
       "gen3 AS (SELECT *, CASE WHEN l1 = lab THEN 1 WHEN l2 = lab THEN 2 WHEN l3 = lab THEN 3 END AS ok_at "
       "FROM gen2)")
GEN_ROWS = """SELECT "index", CASE WHEN ok_at IS NULL THEN 'failed' ELSE 'ok' END AS status,
  CAST(coalesce(ok_at, 3) AS INTEGER) AS attempts,
  CASE WHEN ok_at IS NULL THEN 'answer_mismatch' END AS failure_reason,
  CASE WHEN ok_at IS NOT NULL THEN 'First, compare the options. Therefore, the answer is: (' ||
    CASE ok_at WHEN 1 THEN l1 WHEN 2 THEN l2 ELSE l3 END || ')' END AS reasoning FROM gen3"""


def _gen(spark, sf):
    # rows and per-attempt answers, both already written by the operator
    return generate_reasoning(valid(spark, sf), stub_text_model, SYSTEM)


@register("generate_reasoning", with_ctes(MCQ, CLASSIFIED, VALID, GEN) + GEN_ROWS)
def q_generate_reasoning(spark, sf):
    """L1: free-text reasoning with retries; status per row."""
    return _gen(spark, sf).select("index", "status", "attempts", "failure_reason", "reasoning")


@register("generation_status_counts", with_ctes(MCQ, CLASSIFIED, VALID, GEN) + """,
st AS (SELECT CASE WHEN ok_at IS NULL THEN 'failed' ELSE 'ok' END AS status FROM gen3)
SELECT status, count(*) AS n, round(count(*) / (SELECT count(*) FROM st), 6) AS rate FROM st GROUP BY status""")
def q_generation_status_counts(spark, sf):
    """Success / failed counts and rates."""
    return status_counts(_gen(spark, sf))


JGEN = ("jgen AS (SELECT *, " + ", ".join(f"{_pick_sql(repr(f'{k}:'))} AS l{k}" for k in (1, 2, 3)) +
        ", ('0x' || substr(md5(payload), 1, 2))::BIGINT % 5 <> 0 AS full1"
        " FROM (SELECT *, " + _payload_sql(P_JSON, "0.3", 1000, True) + " AS payload FROM valid)),\n"
        "jgen2 AS (SELECT *, CASE WHEN full1 AND l1 = chr(CAST(65 + label AS INTEGER)) THEN 1 "
        "WHEN l2 = chr(CAST(65 + label AS INTEGER)) THEN 2 WHEN l3 = chr(CAST(65 + label AS INTEGER)) THEN 3 END "
        "AS ok_at FROM jgen)")


@register("generate_json", with_ctes(MCQ, CLASSIFIED, VALID, JGEN) + """
SELECT "index", CASE WHEN ok_at IS NULL THEN 'manual_review' ELSE 'ok' END AS status,
  CAST(coalesce(ok_at, 3) AS INTEGER) AS attempts,
  CASE ok_at WHEN 1 THEN l1 WHEN 2 THEN l2 WHEN 3 THEN l3 END AS answer FROM jgen2""")
def q_generate_json(spark, sf):
    """L2: structured JSON reasoning, field check, answer check, manual review."""
    g = generate_structured(valid(spark, sf), stub_json_model, SYSTEM)
    return g.select("index", "status", "attempts", F.col("reasoning_steps.answer").alias("answer"))


@register("analysis_run", with_ctes(MCQ, CLASSIFIED, VALID) + """,
a AS (SELECT *, ('0x' || substr(md5(payload), 1, 8))::BIGINT AS h, """ + _pick_sql("'1:'") + """ AS ans
  FROM (SELECT *, """ + _payload_sql(P_ANALYSIS, "0.0", 1000, True) + """ AS payload FROM valid))
SELECT "index", source, ['Deductive', 'Sequential', 'Causal'][CAST(h % 3 AS INTEGER) + 1] AS reasoning_type,
  ans = chr(CAST(65 + label AS INTEGER)) AS is_correct FROM a WHERE h % 10 <> 9""")
def q_analysis_run(spark, sf):
    """L3: one attempt, unanswered rows dropped, exact-letter correctness."""
    a = analysis_run(valid(spark, sf), stub_analysis_model, SYSTEM)
    return a.select("index", "source", F.col("analysis.reasoning_type").alias("reasoning_type"), "is_correct")


@register("retry_selection", with_ctes(MCQ, CLASSIFIED, VALID, GEN) + """
SELECT "index", text, question, options, label, source FROM gen3 WHERE ok_at IS NULL""")
def q_retry_selection(spark, sf):
    """Failed rows of a generation run, ready as the next run's input."""
    return _gen(spark, sf).where(F.col("status") == "failed").select(
        "index", "text", "question", "options", "label", "source")


@register("generation_outputs", with_ctes(MCQ, CLASSIFIED, VALID, GEN) + """
SELECT CASE WHEN ok_at IS NULL THEN 'failed' ELSE 'ok' END AS status, count(*) AS n FROM gen3 GROUP BY 1""")
def q_generation_outputs(spark, sf):
    """K5: successes and failures written apart (one folder per status, the
    row index kept in both), read back and counted."""
    from mcqflow.session import scratch_path
    from mcqflow.sources.sinks import save_by_status
    p = scratch_path(spark, "generated_out")
    save_by_status(_gen(spark, sf).select("index", "status", "attempts", "failure_reason", "reasoning"), p)
    return spark.read.json(p).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("generate_resume", with_ctes(MCQ, CLASSIFIED, VALID, GEN) + """,
r AS (SELECT "index", CASE WHEN ok_at IS NULL THEN 'failed' ELSE 'ok' END AS status,
  CAST(coalesce(ok_at, 3) AS INTEGER) AS attempts FROM gen3)
SELECT "index", status, attempts, 1::BIGINT AS calls_run1, (attempts - 1)::BIGINT AS calls_run2, 0::BIGINT AS calls_run3 FROM r""")
def q_generate_resume(spark, sf):
    """L1, L5 with a journal: a run that ended after its first attempt, the run that
    resumes it, and a third run that finds every answer logged; calls of each run by row."""
    from mcqflow.session import scratch_path
    p = scratch_path(spark, "journal")
    v = numbered(valid(spark, sf), "valid")  # the three runs read the same rows
    for run, most in (("1", 1), ("2", 3), ("3", 3)):
        journal = ResponseJournal(spark, p, run)
        rows = generate_reasoning(v, stub_text_model, SYSTEM, max_attempts=most, journal=journal, row_id="_rid")
    calls = journal.log().groupBy("key").agg(*[F.count_if(F.col("run") == k).alias(f"calls_run{k}") for k in "123"])
    return (rows.select("index", "status", "attempts").join(calls, F.col("index").cast("string") == F.col("key"), "left")
            .drop("key").fillna(0, [f"calls_run{k}" for k in "123"]))
