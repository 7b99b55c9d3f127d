"""Packing: limits, whole coverage, checksums against the tokenizer, and the heuristic on demands."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mcqflow.llm import packing, queries

SF = "/root/testdata/sf0.001"


def _by_sequence(rows):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append(r)
    for own in seqs.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at <= packing.TOKENS and len(own) <= packing.SEGMENTS
    return seqs


def _padding(seqs):
    used = np.array([sum(r.length for r in own) for own in seqs.values()])
    return np.where(used & (used - 1), packing.TOKENS - used, 0).sum() / used.sum()


def _ids(texts):
    tok = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    return [np.array(e.ids + [packing.END_ID], "<u4") for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_pieces_hold_every_token_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = packing.pack_documents(docs, queries.vocabulary("word_bpe_49k.json")).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    want = dict(zip(texts, _ids(list(texts.values()))))
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append(r)
    assert got.keys() == want.keys()
    for doc, own in got.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            part = want[doc][at:at + r.length]
            assert (r.start, r.doc_tokens) == (at, len(want[doc])) and r.length > 0
            assert list(r.ids) == part.tolist() and r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(want[doc])
    seqs = _by_sequence(rows)
    assert sorted(seqs) == list(range(len(seqs)))
    assert _padding(seqs) < 0.005


def test_hot_demands_and_repeated_rows(spark):
    """A third of the rows equal, many empty ones, null ids and texts: still little padding, all rows placed."""
    rows = [(k, "a hot text of nine words that repeats " * 70) for k in range(300)] + [(k, "") for k in range(300, 600)] + \
           [(k, "word " * (k % 250 * 7)) for k in range(600, 900)] + [(None, None), (None, None), (1, None), (1, None), (1000, "x y " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = packing.report(docs, queries.vocabulary("word_bpe_49k.json")).collect()
    assert sum(r.start == 0 for r in out) == len(rows)
    assert sum(r.length for r in out) == sum(len(x) for x in _ids([t or "" for _, t in rows]))
    assert _padding(_by_sequence(out)) < 0.005


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.report(docs, queries.vocabulary("word_bpe_49k.json")).count() == 0


def _limits(spark, rows, **limits):
    df = spark.createDataFrame(rows, "id long, n_tokens long, n_loss long, sequence_id string").repartition(3)
    out = packing.pack_examples(df, **limits).collect()
    assert len(out) == len(rows)
    seqs = defaultdict(list)
    for r in out:
        if r.sequence_id is not None:
            seqs[r.sequence_id].append(r)
    for own in seqs.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0] + [r.n_tokens for r in own])[:-1].tolist()
        assert sum(r.n_tokens for r in own) <= limits["room"] and len(own) <= limits["segments"]
        assert sum(r.n_loss or 0 for r in own) <= limits["max_loss"]
    return out, seqs


def test_examples_keep_all_three_limits(spark):
    rng = np.random.RandomState(3)
    rows = [(k, int(t), int(t * rng.rand()), "old") for k, t in enumerate(rng.randint(1, 120, 600))]
    rows += [(k, 40, 40, None) for k in range(1000, 1300)]  # a hot demand
    out, seqs = _limits(spark, rows, room=128, segments=4, max_loss=64, loss_step=1)
    assert {r.id for r in out if r.oversize == "loss"} == {r[0] for r in rows if r[2] > 64}
    assert all((r.sequence_id is None) == (r.oversize is not None) for r in out)
    # the sums of the demands bound the number of sequences from below
    fit = [r for r in rows if r[2] <= 64]
    bound = max(sum(r[1] for r in fit) / 128, len(fit) / 4, sum(r[2] for r in fit) / 64, 300)
    assert len(seqs) <= 1.35 * bound


def test_examples_edge_values(spark):
    rows = [(1, None, None, None), (2, 0, 0, None), (3, 500, 1, None), (4, 5, None, None), (None, 5, 5, None), (None, 5, 5, None)]
    out, seqs = _limits(spark, rows, room=100, segments=8, max_loss=50, loss_step=1)
    assert {r.id: r.oversize for r in out if r.sequence_id is None} == {1: None, 2: None, 3: "tokens"}
    assert len(seqs) == 1


def _plain(tokens, loss, room, segments, max_loss):
    """The same heuristic, one example at a time: the number of sequences."""
    left = sorted(zip(tokens, loss), reverse=True)
    n, size = 0, np.array([room, segments, max_loss], float)
    while left:
        need = np.array([[t, 1, x] for t, x in left]) / size
        w, free, gone = need.mean(0), np.array([room, segments, max_loss]), set()
        while True:
            fits = [k for k in range(len(left)) if k not in gone and (np.array([left[k][0], 1, left[k][1]]) <= free).all()]
            if not fits:
                break
            k = max(fits, key=lambda k: (need[k] * w) @ (free / size))
            gone.add(k)
            free = free - np.array([left[k][0], 1, left[k][1]])
        left = [e for k, e in enumerate(left) if k not in gone]
        n += 1
    return n


@pytest.mark.parametrize("seed", range(5))
def test_counts_stand_for_examples(seed):
    """Filling by demands and counts uses about as many sequences as placing examples one by one."""
    rng = np.random.RandomState(seed)
    demands = sorted({(int(t), min(40, int(t * rng.rand()))) for t in rng.randint(1, 60, 12)})
    counts = rng.randint(1, 12, len(demands))
    t, x = (np.array(c) for c in zip(*demands))
    plan = packing.make_plan(t, x, counts, np.arange(len(t)), 64, 5, 40)
    one = _plain(np.repeat(t, counts).tolist(), np.repeat(x, counts).tolist(), 64, 5, 40)
    assert abs(plan.n_sequences - one) <= max(2, 0.1 * one)


def test_plan_does_not_grow_with_rows():
    rng = np.random.RandomState(0)
    t = np.arange(1, 256)
    c = rng.randint(0, 50, 255)
    sizes = [sum(len(o) for _, o in packing.make_plan(t, t - 1, c * m, t, 256, 16, 256, cut=True).pieces) for m in (10, 10_000)]
    assert sizes[1] < 2 * sizes[0]


def test_query_matches_operator(spark):
    out = queries.QUERIES["op11_packing"](spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.agg(F.sum("length")).first()[0] == out.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
