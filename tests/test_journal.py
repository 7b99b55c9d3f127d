"""Response journal: resume without repeated calls, broken runs, errors, NULL and repeated keys."""

import pytest
from pyspark.sql import functions as F

from mcqflow.operators.journal import ResponseJournal, request_id
from mcqflow.operators.reasoning import analysis_run, call_model, generate_reasoning

COLS = "index long, text string, question string, options array<string>, label long, run string"


def _rows(spark, n=60, poison=None):
    """A column of the table is called ``run``, as one of the journal."""
    return spark.createDataFrame([(i, "poison" if i == poison else f"t{i}", "q", ["a", "b", "c", "d"], i % 4, "x")
                                  for i in range(n)], COLS)


def _model(log, broken=False):
    """Answers A at the first attempt, B at the second, C at the third; a line a call."""
    def fn(payload, attempt):
        if broken and "poison" in payload:
            raise SystemExit("worker lost")
        with open(log, "a") as f:
            f.write(f"{attempt}\n")
        return f"Therefore, the answer is: ({'ABC'[attempt - 1]})"
    return fn


def _calls(log):
    return len(log.read_text().split()) if log.exists() else 0


def _result(df):
    return sorted(tuple(r) for r in df.select("index", "status", "attempts", "failure_reason", "reasoning", "run").collect())


def _run(df, fn, journal=None, **kw):
    return generate_reasoning(df, fn, "sys", chat_body=False, journal=journal, **kw)


def test_broken_run_is_resumed(spark, tmp_path):
    df, log, path = _rows(spark, poison=17), tmp_path / "calls", str(tmp_path / "j")
    want = _result(_run(df, _model(tmp_path / "plain")))
    assert _calls(tmp_path / "plain") == 60 + 45 + 30
    with pytest.raises(Exception):
        _run(df, _model(log, broken=True), ResponseJournal(spark, path, "1", rows_per_task=3))
    kept = ResponseJournal(spark, path).log().count()
    assert 0 < kept < 60  # tasks that had committed
    second = tmp_path / "second"
    assert _result(_run(df, _model(second), ResponseJournal(spark, path, "2"))) == want
    assert _calls(second) == 60 + 45 + 30 - kept
    third = tmp_path / "third"
    assert _result(_run(df, _model(third), ResponseJournal(spark, path, "3"))) == want
    assert _calls(third) == 0
    logged = ResponseJournal(spark, path).log()
    assert logged.select("request_id", "attempt").distinct().count() == logged.count() == 135


def test_changed_prompt_and_more_attempts(spark, tmp_path):
    df, path = _rows(spark, 8), str(tmp_path / "j")
    a, b, c = (tmp_path / x for x in "abc")
    _run(df, _model(a), ResponseJournal(spark, path), max_attempts=1)
    _run(df, _model(b), ResponseJournal(spark, path), max_attempts=2)  # one attempt more for the six others
    _run(df, _model(c), ResponseJournal(spark, path), max_attempts=1, temperature=0.1)  # other requests
    assert [_calls(x) for x in (a, b, c)] == [8, 6, 8]


def test_null_and_repeated_keys_and_payloads(spark, tmp_path):
    rows = [(None, "p"), (None, "p"), ("", "p"), ("k", "p"), ("k", "p"), ("k", "r"), ("n", None)]
    df = spark.createDataFrame(rows, "index string, payload string")
    log, journal = tmp_path / "calls", ResponseJournal(spark, str(tmp_path / "j"))
    got = journal.answer(df, lambda x: call_model(x, _model(log), 1), 1).collect()
    assert len(got) == len(rows) and _calls(log) == 4  # NULL, '', k with p, k with r
    assert sorted((r["index"], r.call_error) for r in got if r.response is None) == [("n", "no payload")]
    empty = tmp_path / "empty"
    assert journal.answer(df.limit(0), lambda x: call_model(x, _model(empty), 1), 1).count() == 0 and not empty.exists()
    ids = df.select(request_id("index").alias("i")).distinct().count()
    assert ids == 5  # with the NULL payload's


def test_errors_and_repeated_log_rows(spark, tmp_path):
    path = str(tmp_path / "j")
    df = spark.createDataFrame([(1, "p"), (2, "r")], "index long, payload string")

    def failing(payload, attempt):
        if payload == "p":
            raise TimeoutError("no response")
        return "second"

    def ask(fn, **kw):
        j = ResponseJournal(spark, path, **kw)
        got = j.answer(df, lambda x: call_model(x, fn, 1), 1)
        return sorted((r["index"], r.response, r.call_error) for r in got.collect())
    assert ask(failing) == [(1, None, "TimeoutError: no response"), (2, "second", None)]
    assert ask(lambda p, a: "again") == [(1, None, "TimeoutError: no response"), (2, "second", None)]
    assert ask(lambda p, a: "again", retry_errors=True) == [(1, "again", None), (2, "second", None)]
    j = ResponseJournal(spark, path)
    j._write(j.log().limit(10))  # a task that committed twice
    assert ask(failing) == [(1, "again", None), (2, "second", None)]


def test_batches_are_bounded(spark, tmp_path):
    df = spark.range(23).select(F.col("id").alias("index"), F.col("id").cast("string").alias("payload")).coalesce(1)

    def fn(payload, attempt):
        import threading
        return str(threading.active_count())
    got = call_model(df, fn, 1, concurrency=4, batch_size=5).collect()
    assert sorted(r["index"] for r in got) == list(range(23)) and all(r.call_error is None for r in got)
    assert max(int(r.response) for r in got) <= 6


def test_analysis_run_with_journal(spark, tmp_path):
    log, path = tmp_path / "calls", str(tmp_path / "j")

    def fn(payload, attempt):
        with open(log, "a") as f:
            f.write("1\n")
        return '{"correct_answer": "A", "reasoning_type": "Deductive"}'
    for _ in range(2):
        r = analysis_run(_rows(spark, 8), fn, "sys", chat_body=False, journal=ResponseJournal(spark, path))
        assert r.where("is_correct").count() == 2 and r.count() == 8
    assert _calls(log) == 8


def _bulky(spark, n=40):
    """Texts of 20 KB that do not compress well."""
    import random
    r = random.Random(7)
    return spark.createDataFrame([(i, "".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=20000)), "q",
                                   ["a", "b", "c", "d"], i % 4, "x") for i in range(n)], COLS)


def _size(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


@pytest.mark.parametrize("journaled", [True, False])
def test_texts_are_not_written_with_every_attempt(spark, tmp_path, monkeypatch, journaled):
    """Three journaled runs of numbered rows write no text, one plain run the rows once and what is asked again."""
    from mcqflow import session
    from mcqflow.operators.dedup import numbered
    df, text = numbered(_bulky(spark), "bulky"), 40 * 20000
    monkeypatch.setattr(session, "scratch_path", lambda s, name: str(tmp_path / "scratch" / f"{name}-{len(list(tmp_path.glob('scratch/*')))}"))
    for run, most in (("1", 1), ("2", 3), ("3", 3)) if journaled else (("1", 3),):
        journal = ResponseJournal(spark, str(tmp_path / "j"), run) if journaled else None
        got = _run(df, _model(tmp_path / "calls"), journal, max_attempts=most, row_id="_rid")
    assert got.select("text").distinct().count() == 40
    assert [r["n"] for r in got.groupBy("status", "attempts").agg(F.count("*").alias("n")).orderBy("n", "attempts").collect()] == [10] * 4
    assert _calls(tmp_path / "calls") == 40 + 30 + 20
    assert _size(tmp_path) < (0.2 if journaled else 1.5) * text


def test_python_gets_requests_only(spark, monkeypatch, tmp_path):
    """What goes to Python is the request, not the row; batches there are views of at most ``batch_size`` rows."""
    from mcqflow.operators import reasoning
    seen, real = [], reasoning.call_model

    def spy(df, *a, **kw):
        seen.append(set(df.columns))
        return real(df, *a, **kw)
    monkeypatch.setattr(reasoning, "call_model", spy)
    df = _rows(spark, 8)
    assert _run(df, _model(tmp_path / "a")).count() == 8
    assert analysis_run(df, lambda p, a: '{"correct_answer": "A"}', "sys", chat_body=False).count() == 8
    assert len(seen) == 4 and all(c <= {"_rid", "label", "payload"} for c in seen), seen


def test_call_model_keeps_types_and_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (None, ["x"], "p")], "i long, a array<string>, payload string")
    got = call_model(df, lambda p, a: None if p is None else p * a, 2)
    assert dict(got.dtypes)["i"] == "bigint" and {(r.i, tuple(r.a or ()), r.response) for r in got.collect()} == {
        (1, (), None), (None, ("x",), "pp")}


def test_copies_of_a_request_share_one_call_and_keep_all_rows(spark, tmp_path):
    df, log = _rows(spark, 4), tmp_path / "calls"
    df = df.unionByName(df).unionByName(df.withColumn("index", F.lit(None).cast("long")))
    rows = _run(df, _model(log), ResponseJournal(spark, str(tmp_path / "j")))
    assert rows.count() == 12 and rows.where("status = 'ok'").count() == 9
    assert _calls(log) == 8 + 6 + 4
    assert _result(rows.where("index is not null")) == sorted(2 * _result(_run(_rows(spark, 4), _model(tmp_path / "plain"))))
