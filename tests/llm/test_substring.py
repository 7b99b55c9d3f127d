"""Substring dedup against a word-by-word brute force."""

import hashlib
import random
import re

import pytest

from mcqflow.llm import substring

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] is None, r[1])):
        w = WORD.findall(text or "")
        cut = [False] * len(w)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            if k in seen:
                cut[i:i + window] = [True] * window
            seen.add(k)
        kept = " ".join(x for x, c in zip(w, cut) if not c)
        out.append((doc_id, len(w), sum(cut), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, schema="doc_id long, text string", **kw):
    df = substring.dedup_substrings(spark.createDataFrame(rows, schema), **kw)
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def test_repeats_inside_and_across_documents(spark):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(60)] + ["für", "é", "日本"]
    passage = [rng.choice(vocab) for _ in range(70)]
    rows = []
    for i in range(40):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 120))]
        if i % 3 == 0:
            at = rng.randint(0, len(w))
            cut = rng.randint(0, 30)
            w[at:at] = passage[cut:cut + rng.randint(5, 40)]
        if i % 7 == 0:
            w = w + w
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(40, rows[3][1]), (41, "a " * 500), (42, None), (43, ""), (44, " \n "), (45, " ".join(passage))]
    assert run(spark, rows) == brute(rows)


def test_short_windows_and_levels(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60)))) for i in range(30)]
    assert run(spark, rows, window=8, levels=3) == brute(rows, 8)
    assert run(spark, rows, window=6, levels=2) == brute(rows, 6)
    with pytest.raises(ValueError):
        run(spark, rows, window=10, levels=3)


def test_null_ids_repeated_rows_empty_table_clashing_columns(spark):
    p = " ".join(f"x{i}" for i in range(25))
    rows = [(None, p), (1, p), (1, p), (None, p + " tail")]
    got = run(spark, rows)
    assert sorted(r[2] for r in got) == [0, 25, 25, 25]
    assert [r[2] for r in got if r[0] is None] == [25, 25]
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, p, "keep", 9), (2, p, "me", 9)], "doc_id long, text string, lang string, n_words int")
    out = {r.doc_id: r for r in substring.dedup_substrings(df).collect()}
    assert out[1].text == p and out[2].text == "" and out[2].lang == "me" and out[2].n_words == 25


def test_very_long_text(spark):
    w = [f"t{i % 5000}" for i in range(60000)]
    got = run(spark, [(1, " ".join(w))])
    # from the second round on every window repeats; the first window of round two starts at word 5000
    assert got[0][1:3] == (60000, 55000)
