"""Phrase mining against plain counting."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from mcqflow.llm import phrases

SF = "/root/testdata/sf0.001"


def brute(rows, n=3, min_count=10, cover=50, top=2000):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for size in range(1, n + 1):
                f[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        held = Counter()
        for p, a in cand.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    held[p[i:i + size]] = max(held[p[i:i + size]], a)
        rows_ = []
        for p, a in cand.items():
            if 100 * held[p] >= cover * a:
                continue
            score, _, l, r = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), l, r))
        for k, (s, a, p, l, r) in enumerate(sorted(rows_)[:top]):
            out.append((lang, k + 1, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "lang string, text string, phrase string, n long").repartition(3)
    return sorted(map(tuple, phrases.collocations(df, **kw).collect()))


def made(seed, n_docs=120):
    rng = np.random.RandomState(seed)
    vocab = ["New", "york", "the", "of", "city", "a", "b", "été", "\U0001F600", "x-y", "re", "\xa0z"]
    out = []
    for _ in range(n_docs):
        w = rng.choice(vocab, rng.randint(0, 60), p=rng.dirichlet(np.ones(len(vocab))))
        out.append((rng.choice(["en", "de", "und", None]), "".join(x + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b"], p=[.7, .05, .05, .1, .04, .03, .03]) for x in w)))
    return [(None if a is None else str(a), b) for a, b in out]


@pytest.mark.parametrize("seed, kw", [(0, {}), (1, {"n": 2, "min_count": 3}), (2, {"n": 4, "min_count": 4, "top": 25, "cover_pct": 70})])
def test_random_texts(spark, seed, kw):
    rows = made(seed) + [("en", None), ("en", ""), (None, " ,. "), ("en", "same words here " * 30), ("en", "same words here " * 30)]
    want = brute(rows, kw.get("n", 3), kw.get("min_count", 10), kw.get("cover_pct", 50), kw.get("top", 2000))
    assert len(want) > 20 and run(spark, rows, **kw) == want


def test_empty_and_wordless(spark):
    assert run(spark, []) == []
    assert run(spark, [("en", None), (None, "?!")]) == []


def test_salts_and_marks(spark, monkeypatch):
    """Shared hashes lead to another salt, and a bitmap that marks every word changes no result."""
    rows, want = made(3), brute(made(3))
    scan = phrases.scan

    def poor(buf, off, salt=0):  # at the first salt words of one length share a hash
        low, s, e, h, piece = scan(buf, off, salt)
        return low, s, e, h if salt else (e - s).astype(np.uint64), piece
    buf, off = phrases.W.text_bytes(phrases.pa.array(["ab cd", "ab"]))
    assert (scan(buf, off, 0)[3] != scan(buf, off, 1)[3]).all()
    monkeypatch.setattr(phrases, "marks", lambda frequent: b"\xff" * (1 << (phrases.MARK_BITS - 3)))
    assert run(spark, rows) == want


def test_exact_scores_beyond_64_bits(spark):
    """Products of counts pass 64 bits without loss."""
    df = spark.createDataFrame([(10**11 + 7, 10**11 + 9, 10**11 + 11)], "a long, l long, r long")
    x = df.selectExpr("(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0))) as s")
    a, l, r = 10**11 + 7, 10**11 + 9, 10**11 + 11
    assert x.first().s == 10**6 * a * a // (l * r)
