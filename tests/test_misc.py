"""Pluggable tokenizer, catalogue, sinks, streaming, model-call status."""

import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from mcqflow.functions.prompt import prompt_length_style, token_length_udf
from mcqflow.operators.reasoning import generate_reasoning, status_counts
from mcqflow.plans.q_clean import valid
from mcqflow.sources.native import check_catalogue, read_catalogue
from mcqflow.sources.sinks import save_dataset
from mcqflow.streaming.answers import reasoning_check_stream


def test_token_length_udf(spark):
    v = valid(spark, SF_SMALL).limit(20)
    n = v.select(token_length_udf(str.split)(prompt_length_style()).alias("n"),
                 prompt_length_style().alias("p")).collect()
    assert all(r.n == len(r.p.split()) for r in n)


def test_catalogue_skip_and_fail(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text(json.dumps({"text": "t", "question": "q", "options": ["a", "b"], "label": 0}) + "\n")
    entries = [("a", "mcq", str(path)), ("b", "mcq", str(tmp_path / "missing.jsonl"))]
    present, missing = check_catalogue(spark, entries)
    assert [p[0] for p in present] == ["a"] and [m[0] for m in missing] == ["b"]
    assert read_catalogue(spark, entries).collect()[0].dataset == "a"
    row = read_catalogue(spark, entries).collect()[0]
    assert (row["index"], row.source) == (0, "a")
    try:
        check_catalogue(spark, entries, mode="fail")
        assert False
    except FileNotFoundError as e:
        assert "missing.jsonl" in str(e)


def test_save_dataset_round_trip(spark, tmp_path):
    v = valid(spark, SF_SMALL).select("index", "text", "question", "options", "label", "source")
    save_dataset(v, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "data.parquet")).count() == v.count()
    assert spark.read.json(str(tmp_path / "out" / "json")).count() == v.count()


def test_stream_matches_batch(spark, tmp_path):
    rows = [{"index": 1, "text": "t", "question": "q", "options": ["a", "b"], "label": 1,
             "reasoning": "First, think. Therefore, the answer is: (B)"},
            {"index": 2, "text": "t", "question": "q", "options": ["a", "b"], "label": 0,
             "reasoning": "no idea"}]
    src = tmp_path / "src"
    src.mkdir()
    (src / "part.json").write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    q = reasoning_check_stream(spark, str(src), str(tmp_path / "sink"), str(tmp_path / "ck"))
    q.awaitTermination()
    got = {r["index"]: r for r in spark.read.parquet(str(tmp_path / "sink")).collect()}
    assert got[1].valid and got[1].extracted == "B"
    assert set(got[2].problems) == {"answer_wrong", "no_step_marker", "no_conclusion"}


def test_generation_retries_and_failures(spark):
    calls = {"n": 0}

    def model(payload, attempt):
        body = json.loads(payload)
        user = body["messages"][1]["content"]
        if "Italian" in user:
            raise RuntimeError("boom")
        letter = "B" if attempt >= 2 else "A"
        return json.dumps({"choices": [{"message": {"content": f"The answer is: ({letter})"}}]})

    v = valid(spark, SF_SMALL).where(F.size("options") >= 2)
    g = generate_reasoning(v, model, "sys").cache()
    rows = g.collect()
    assert len(rows) == v.count()
    for r in rows:
        if "Italian" in r.options:
            assert r.status == "failed" and r.failure_reason.startswith("call_error")
        elif r.label == 0:
            assert r.status == "ok" and r.attempts == 1
        elif r.label == 1:
            assert r.status == "ok" and r.attempts == 2
        else:
            assert r.status == "failed" and r.failure_reason == "answer_mismatch" and r.attempts == 3
    assert {x.status for x in status_counts(g).collect()} <= {"ok", "failed"}


def test_pair_responses_keeps_both_sides(spark):
    from mcqflow.operators.reasoning import pair_responses
    req = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (None, 3)], "index long, label int")
    resp = spark.createDataFrame([(1, 0, "old"), (1, 1, "new"), (2, 0, None), (9, 0, "x")], "index long, attempt int, response string")
    got = {(r["index"], r["label"], r["response"], r["pair_status"]) for r in pair_responses(req, resp).collect()}
    assert got == {(1, 0, "new", "paired"), (2, 1, None, "paired"), (3, 2, None, "missing"), (None, 3, None, "missing"), (9, None, "x", "extra")}
    assert pair_responses(req.limit(0), resp.limit(0)).count() == 0


def test_sliding_windows_from_running_totals(spark, monkeypatch):
    """Every stride and stretch length gives the counts of plain windows."""
    from mcqflow.operators import stats
    monkeypatch.setattr(stats, "BLOCKS_PER_TASK", 3)
    n = 237
    df = spark.range(n).select(F.col("id").alias("pos"), F.concat(F.lit("s"), (F.col("id") * F.col("id") % 3).cast("string")).alias("source"))
    rows = [(r.pos, r.source) for r in df.collect()]
    for stride in (5, 10, 50):
        got = {(r.window, r.source): r.avg_per_chunk for r in stats.source_trend(df, chunk=10, window=5, stride=stride).collect()}
        assert len(got) == -(-n // stride) * len({s for _, s in rows})
        for (w, s), v in got.items():
            assert abs(v - sum(w * stride <= p < w * stride + 50 and s == t for p, t in rows) / 5) < 1e-6
