"""Periodic runs against a brute-force search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

from mcqflow.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def brute_runs(w, least=6, power=4):
    out, n = set(), len(w)
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if size >= max(least, power * q) and not any(w[i:i + size - p] == w[i + p:i + size] for p in range(1, q)):
                out.add((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def random_text(rng):
    w = []
    for _ in range(rng.randint(0, 6)):
        if rng.random() < 0.6:
            base = [rng.choice("ab" if rng.random() < 0.5 else "abcd") for _ in range(rng.randint(1, 9))]
            w += (base * rng.randint(1, 12))[:rng.randint(1, 60)]
        else:
            w += [rng.choice("abc") for _ in range(rng.randint(1, 8))]
    return rng.choice([" ", "\n", "  \t"]).join(w)


def test_random_texts_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, random_text(rng)) for k in range(1500)]
    rows += [(None, "a " * 30), (None, None), (1500, None), (1501, ""), (1502, " \n"), (7, "b a " * 9), (7, "b a " * 9),
             (1503, "x y z " * 3000), (1504, "été été " * 5 + "\U0001F600 " * 6)]
    got = periodic.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).drop("n_words").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got), key=str) == sorted((brute_row(*r) for r in rows), key=str)
    assert sum(r.n_runs for r in got) > 1000 and key


def test_query_on_whole_table_with_short_texts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[:8] for r in queries.QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    short = [d for d, t in docs.items() if len(t or "") < 6000]
    assert len(short) > 100
    for d in short:
        assert got[d] == brute_row(d, docs[d])


def test_general_operator(spark):
    docs = spark.createDataFrame([(1, "go on and on and on and on and on now", "x"), (2, "plain  text", "y"), (3, None, "z")],
                                 "doc_id long, text string, runs string")
    out = {r.doc_id: r for r in periodic.find_runs(docs).collect()}
    assert [tuple(x) for x in out[1].runs] == [(1, 9, 2)] and out[1].collapsed == "go on and now"
    assert out[2].runs == [] and out[3].collapsed is None and out[3].n_words == 0
    kept = {r.doc_id: (r.text, r.runs) for r in periodic.collapse_runs(docs).collect()}
    assert kept == {1: ("go on and now", "x"), 2: ("plain  text", "y"), 3: (None, "z")}
    assert periodic.find_runs(docs.limit(0)).count() == 0
