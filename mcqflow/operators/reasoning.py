"""Reasoning validation, accuracy and batch model calls.

Validation and accuracy are pure DataFrame aggregates.  Model calls run in
``mapInArrow`` around a user-supplied callable (one HTTP client per Python
worker, ``batch_size`` rows at a time); status columns stand for separate
success and failure files.  With a response journal a broken run is resumed
without asking again for what was answered (``operators.journal``).
"""

from __future__ import annotations

from typing import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mcqflow.functions.answers import (answer_correct, extract_answer, has_conclusion,
                                       has_step_marker, reasoning_problems, response_content)
from mcqflow.operators.dedup import numbered
from mcqflow.operators.index import MAX_INT_BUCKETS, int_bucket, ranked
from mcqflow.operators.journal import ResponseJournal, request_id


def validation_stats(df: DataFrame, reasoning: str = "reasoning", label: str = "label",
                     letters: str = "ABCDEF", **limits) -> DataFrame:
    """Totals and % (valid = no problem at all; answer_correct separate)."""
    r = F.col(reasoning)
    x = df.select(reasoning_problems(r, F.col(label), letters, **limits).alias("p"),
                  answer_correct(extract_answer(r, letters), F.col(label)).alias("ok"),
                  has_step_marker(r).alias("st"), has_conclusion(r).alias("cc"))
    n = F.count(F.lit(1))

    def rate(c: Column) -> Column:
        return F.round(F.when(n > 0, F.count_if(c) * 100.0 / n), 6)

    return x.agg(n.alias("total"), F.count_if(F.size("p") == 0).alias("valid_samples"),
                 F.count_if("ok").alias("answer_correct"), F.count_if("st").alias("has_step_by_step"),
                 F.count_if("cc").alias("has_conclusion"),
                 F.count_if(F.size("p") > 0).alias("invalid_samples"),
                 rate(F.size("p") == 0).alias("valid_rate"), rate(F.col("st")).alias("step_rate"),
                 rate(F.col("cc")).alias("conclusion_rate"))


def accuracy_by_type(df: DataFrame, label: str = "label") -> DataFrame:
    """A16: 'ALL' divides by every input row; per reasoning_type divides by
    answered rows only (as the source report does)."""
    x = df.withColumn("is_correct", F.coalesce(F.col("correct_answer") == F.char(F.lit(65) + F.col(label)),
                                               F.lit(False)))
    acc = F.round(F.count_if("is_correct") / F.count(F.lit(1)), 6)
    overall = x.agg(F.lit("ALL").alias("reasoning_type"), F.count(F.lit(1)).alias("n"),
                    F.count_if("is_correct").alias("correct"), acc.alias("accuracy"))
    per = (x.where(F.col("correct_answer").isNotNull()).groupBy("reasoning_type")
           .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_correct").alias("correct"), acc.alias("accuracy")))
    return overall.unionByName(per)


def pair_responses(requests: DataFrame, responses: DataFrame, key: str = "index") -> DataFrame:
    """Requests and recorded responses (key, attempt, response) joined on ``key``.
    ``pair_status`` is paired, missing (no response) or extra (no request), so no row
    of either side is lost; of several responses to one key the latest attempt counts."""
    last = (responses.groupBy(key).agg(F.max(F.struct("attempt", "response")).alias("_r"))
            .select(key, F.col("_r.response").alias("response"), F.lit(True).alias("_resp")))
    req = requests.drop("response", "pair_status").withColumn("_req", F.lit(True))
    status = F.when(F.col("_req").isNull(), "extra").when(F.col("_resp").isNull(), "missing").otherwise("paired")
    return req.join(last, key, "full_outer").withColumn("pair_status", status).drop("_req", "_resp")


def index_slice(df: DataFrame, start: int = 0, end: int | None = None, order: str = "index") -> DataFrame:
    """Rows at input positions [start, end); NULL end = to the end, 0 = none.
    Adds ``pos`` (0-based position) and ``slice_index`` = pos - start."""
    r = ranked(df, [order], int_bucket(df, order), (), "_p", n_buckets=MAX_INT_BUCKETS + 1)
    r = r.withColumn("pos", F.col("_p") - 1).drop("_p")
    cond = F.col("pos") >= start
    if end is not None:
        cond = cond & (F.col("pos") < end)
    return r.where(cond).withColumn("slice_index", F.col("pos") - start)


# ---- batch model calls ------------------------------------------------------
# ``fn(payload_json: str, attempt: int) -> str`` is user code (an HTTP client,
# a local model ...).  It runs inside Python workers over batches of at most
# ``batch_size`` rows, with ``concurrency`` calls in flight per task.  Responses
# are written to the shared folder after every attempt, or to the journal task
# by task: a lost executor or a re-planned stage must never call the model
# again for rows already answered.  Only requests travel to Python and between
# attempts: the rows are numbered and meet their answers by number at the end.

BATCH_SIZE = 50


def call_model(df: DataFrame, fn: Callable[[str, int], str], attempt: int, payload: str = "payload",
               out: str = "response", concurrency: int = 20, batch_size: int = BATCH_SIZE) -> DataFrame:
    from pyspark.sql import types as T
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.StringType()),
                                              T.StructField("call_error", T.StringType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from concurrent.futures import ThreadPoolExecutor

        def one(p):
            try:
                return fn(p, attempt), None
            except Exception as e:  # noqa: BLE001 -- recorded per row
                return None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(max_workers=concurrency) as ex:
            for rows in batches:
                for at in range(0, rows.num_rows, batch_size):
                    part = rows.slice(at, batch_size)  # a view: only these payloads become Python strings
                    res = list(ex.map(one, part.column(payload).to_pylist()))
                    added = [pa.array([r[k] for r in res], pa.string()) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


ANSWER = ["response", "call_error", "attempts", "accepted"]


def _requests(df: DataFrame, payload: Column, keep: list[str], journal: ResponseJournal | None, key: str,
              row_id: str | None) -> tuple[DataFrame, DataFrame, str]:
    """The rows, numbered, with their payload; the requests: number, ``keep`` and the
    payload, for which with a journal its request id stands; the number's name."""
    from mcqflow.session import materialize
    rid = row_id or "_rid"
    rows = (df if row_id else numbered(df, "rows")).drop(*ANSWER).withColumn("payload", payload)
    if journal is None:
        return rows, rows.select(*dict.fromkeys([rid, *keep, "payload"])), rid
    asked = rows.withColumn("request_id", request_id(key)).select(*dict.fromkeys([rid, *keep, key, "request_id"]))
    return rows, materialize(asked, "requests"), rid


def _answers(requests: DataFrame, fn, attempt: int, concurrency: int, batch_size: int,
             journal: ResponseJournal | None, key: str, rows: DataFrame, rid: str) -> DataFrame:
    """``requests`` with response and call_error, by calls or from the journal."""
    def call(x):
        return call_model(x, fn, attempt, concurrency=concurrency, batch_size=batch_size)
    return call(requests) if journal is None else journal.answer(requests, call, attempt, key, rows=rows, row_id=rid)


def _with_answers(rows: DataFrame, answers: DataFrame, rid: str, row_id: str | None) -> DataFrame:
    out = rows.join(answers, rid)
    return out if row_id else out.drop(rid)


def _attempts(df: DataFrame, payload: Column, fn, max_attempts: int, judge: Callable[[DataFrame], Column],
              concurrency: int, chat_body: bool = True, batch_size: int = BATCH_SIZE,
              journal: ResponseJournal | None = None, key: str = "index", row_id: str | None = None) -> DataFrame:
    """Runs attempts 1..max_attempts; each attempt only for rows not yet
    accepted (L5: failed rows are the next input).  Adds payload, response,
    call_error, attempts, accepted.  ``judge`` sees the label and the answer.
    ``row_id`` names a column that numbers the rows of a written ``df``;
    without it they are written once with a number."""
    from mcqflow.session import materialize
    rows, pending, rid = _requests(df, payload, ["label"], journal, key, row_id)
    done = None
    for attempt in range(1, max_attempts + 1):
        got = _answers(pending, fn, attempt, concurrency, batch_size, journal, key, rows, rid)
        if chat_body:  # P24: the message text of a chat-completions body
            got = got.withColumn("response", response_content(F.col("response")))
        got = got.withColumn("attempts", F.lit(attempt)).withColumn("accepted", judge(got))
        if journal is None:  # only a retry needs the payload again
            retry = F.lit(False) if attempt == max_attempts else ~F.col("accepted")
            got = got.withColumn("payload", F.when(retry, F.col("payload")))
        # written with its verdict: the checks run once, next to the call
        got = materialize(got, f"attempt{attempt}")
        pending = got.where(~F.col("accepted"))
        ok = got.where("accepted").select(rid, *ANSWER)
        done = ok if done is None else done.unionByName(ok)
        if attempt == max_attempts:
            done = done.unionByName(pending.select(rid, *ANSWER))
        pending = pending.drop(*ANSWER)
    return _with_answers(rows, done, rid, row_id)


def generate_reasoning(df: DataFrame, fn, system_prompt: str, model: str = "model",
                       temperature: float = 0.7, max_tokens: int = 2000, letters: str = "ABCD",
                       max_attempts: int = 3, concurrency: int = 20, chat_body: bool = True,
                       batch_size: int = BATCH_SIZE, journal: ResponseJournal | None = None, key: str = "index",
                       row_id: str | None = None) -> DataFrame:
    """L1: step-by-step prompt -> call -> extract letter -> accept if right,
    else retry; after the last attempt the row is 'failed' with a reason."""
    from mcqflow.functions.prompt import prompt_steps_style, request_payload
    payload = request_payload(prompt_steps_style(), system_prompt, model, temperature, max_tokens)

    def judge(g):
        return F.coalesce(answer_correct(extract_answer(F.col("response"), letters), F.col("label")),
                          F.lit(False)) & F.col("call_error").isNull()

    r = _attempts(df, payload, fn, max_attempts, judge, concurrency, chat_body, batch_size, journal, key, row_id)
    return (r.withColumn("status", F.when(F.col("accepted"), "ok").otherwise("failed"))
            .withColumn("failure_reason", F.when(F.col("accepted"), None)
                        .when(F.col("call_error").isNotNull(), F.concat(F.lit("call_error: "), F.col("call_error")))
                        .otherwise(F.lit("answer_mismatch")))
            .withColumn("reasoning", F.when(F.col("accepted"), F.col("response"))))


def generate_structured(df: DataFrame, fn, system_prompt: str, model: str = "model",
                        temperature: float = 0.3, max_tokens: int = 1000,
                        max_attempts: int = 3, concurrency: int = 20, chat_body: bool = True,
                        batch_size: int = BATCH_SIZE, journal: ResponseJournal | None = None, key: str = "index",
                        row_id: str | None = None) -> DataFrame:
    """L2: JSON-object responses; all seven fields must be present and the
    answer (stripped, upper-cased) must match, else retry; then
    'manual_review'.  Parsed response in ``reasoning_steps``."""
    from mcqflow.functions.answers import has_fields, json_answer_correct
    from mcqflow.functions.prompt import prompt_json_style, request_payload
    from mcqflow.schema import REASONING_FIELDS, REASONING_STRUCT
    payload = request_payload(prompt_json_style(), system_prompt, model, temperature, max_tokens, json_object=True)

    def judge(g):
        ans = F.get_json_object(F.col("response"), "$.answer")
        return (F.col("call_error").isNull() & has_fields(F.col("response"), REASONING_FIELDS)
                & json_answer_correct(ans, F.col("label")))

    r = _attempts(df, payload, fn, max_attempts, judge, concurrency, chat_body, batch_size, journal, key, row_id)
    return (r.withColumn("status", F.when(F.col("accepted"), "ok").otherwise("manual_review"))
            .withColumn("reasoning_steps", F.when(F.col("accepted"), F.from_json("response", REASONING_STRUCT))))


def analysis_run(df: DataFrame, fn, system_prompt: str, model: str = "model",
                 concurrency: int = 20, chat_body: bool = True, batch_size: int = BATCH_SIZE,
                 journal: ResponseJournal | None = None, key: str = "index", row_id: str | None = None) -> DataFrame:
    """L3: one attempt with the analysis prompt; unanswered rows are dropped;
    ``is_correct`` = exact letter match (P14d)."""
    from mcqflow.functions.answers import exact_answer_correct
    from mcqflow.functions.prompt import prompt_analysis_style, request_payload
    from mcqflow.schema import ANALYSIS_STRUCT
    from mcqflow.session import materialize
    payload = request_payload(prompt_analysis_style(), system_prompt, model, 0.0, 1000, json_object=True)
    rows, asked, rid = _requests(df, payload, [], journal, key, row_id)
    answers = _answers(asked, fn, 1, concurrency, batch_size, journal, key, rows, rid)
    got = materialize(answers.select(rid, "response", "call_error"), "analysis")
    got = _with_answers(rows, got, rid, row_id)
    if chat_body:
        got = got.withColumn("response", response_content(F.col("response")))
    a = F.when(F.expr("try_parse_json(response)").isNotNull(), F.from_json("response", ANALYSIS_STRUCT))
    got = got.withColumn("analysis", a).where(F.col("analysis").isNotNull())
    return got.withColumn("is_correct", exact_answer_correct(F.col("analysis.correct_answer"), F.col("label")))


def status_counts(df: DataFrame) -> DataFrame:
    """Rows per status and the success rate."""
    c = df.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("t")).select("t").scalar()
    return c.withColumn("rate", F.round(F.col("n") / total, 6))
