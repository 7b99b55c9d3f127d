"""The quality classifier and the pipeline against plain loops."""

import itertools
import math
import re

import numpy as np
import pandas as pd
import pytest
import sentencepiece

import corpus_pipeline
from mcqflow.llm import quality_mil
from mcqflow.llm import words as W
from mcqflow.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return [w.decode() for w in WORD.findall((text or "").encode())]


def word_hash(word):
    return int(W.span_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])


def passage_vectors(text):
    """What ``encode`` gives for one text, a word and a byte at a time."""
    raw = (text or "").encode()
    spans = [m.span() for m in WORD.finditer(raw)]
    w = [raw[a:z] for a, z in spans]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    out = []
    for lo in range(0, len(w), quality_mil.PASSAGE):
        ids = range(lo, min(lo + quality_mil.PASSAGE, len(w)))
        n = len(ids)
        inside = raw[spans[ids[0]][0]:spans[ids[-1]][1]]
        v = [sum(c in chars for c in inside) / len(inside) for chars in quality_mil._CLASS.values()]
        sizes = [len(w[i]) for i in ids]
        mean = sum(sizes) / n
        v += [mean / 10, math.sqrt(max(0, sum(s * s for s in sizes) / n - mean * mean)) / 5,
              len({w[i] for i in ids}) / n, sum(i > 0 and w[i] == w[i - 1] for i in ids) / n,
              math.log1p(n) / math.log1p(quality_mil.PASSAGE),
              sum(w[i] in w[:i] for i in ids) / n,
              sum(i < len(grams) and grams[i] in grams[:i] for i in ids) / n,
              math.log1p(len(w)) / 10]
        fold = [0] * quality_mil._FOLD
        for i in ids:
            fold[word_hash(w[i]) >> 60] += 4 / n
        out.append(v + fold)
    return out or [[0.0] * quality_mil.N_FEATURES]


def attention_score(p, vectors):
    """Gated attention over the passages, a number at a time."""
    def dot(x, column):
        return sum(a * float(b) for a, b in zip(x, column))
    hidden, gates = [], []
    for v in vectors:
        z = [min(6, max(-6, (a - float(m)) / float(s))) for a, m, s in zip(v, p["mu"], p["sd"])]
        hidden.append([math.tanh(dot(z, p["W"][:, k]) + float(p["c"][k])) for k in range(p["W"].shape[1])])
        gates.append(sum(math.tanh(dot(z, p["V"][:, k])) / (1 + math.exp(-dot(z, p["U"][:, k]))) * float(p["w"][k])
                         for k in range(p["V"].shape[1])))
    share = [math.exp(g - max(gates)) for g in gates]
    bag = [sum(s * h[k] for s, h in zip(share, hidden)) / sum(share) for k in range(len(hidden[0]))]
    return 1 / (1 + math.exp(-dot(bag, p["o"]) - float(p["b"][0])))


def edits(item, text):
    """Least edits that turn the item into some passage of the text."""
    t = np.array(list(text), "U1")
    at = np.arange(len(t) + 1)
    prev = np.zeros(len(t) + 1, int)
    for a in item:
        cur = prev + 1
        cur[1:] = np.minimum(cur[1:], prev[:-1] + (t != a))
        prev = np.minimum.accumulate(cur - at) + at
    return int(prev.min())


def kept_words(rows):
    """doc_id to the words outside windows of 20 that start earlier."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        w = words(text)
        cut = set()
        for i in range(len(w) - 19):
            k = tuple(w[i:i + 20])
            if k in seen:
                cut.update(range(i, i + 20))
            seen.add(k)
        out[doc_id] = [x for i, x in enumerate(w) if i not in cut]
    return out


def shingles(text):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def survivors(rows):
    """The least doc_id of each group of texts linked at 0.8."""
    sets = {d: shingles(t) for d, t in rows}
    top = {d: d for d in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) * 10 >= 8 * len(sets[a] | sets[b]) and top[a] != top[b]:
            low, high = sorted((top[a], top[b]))
            top = {d: low if g == high else g for d, g in top.items()}
    return set(top.values())


def test_quality_scores_against_plain_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    params = quality_mil.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    texts = [None, "", " \n", "one", "a a a a a a b", "für 日本 #* $% one. Two, THREE! 4?", "x y z v w " * 60, "é" * 3000,
             *(r.text for r in docs.orderBy("doc_id").limit(25).collect())]
    got = quality_mil.classify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), params).collect()
    assert len(got) == len(texts)
    for r in got:
        want = attention_score(params, passage_vectors(r.text))
        assert r.score == pytest.approx(want, abs=1e-3)
        assert r.predicted == (1 if r.score >= 0.3 else 0)


def test_pipeline_rows_against_plain_loops(spark, tmp_path, monkeypatch):
    """Every stage's rows, from the rows that its predecessor wrote."""
    docs = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id").head(60)
    labels, bench = pd.read_parquet(f"{SF}/labels.parquet"), pd.read_parquet(f"{SF}/benchmark.parquet").head(12)
    good = [r for r in docs.itertuples() if len(words(r.text)) > 60][:12]
    extra = []
    for n, r in enumerate(good):
        w = words(r.text)
        other = words(good[(n + 5) % 12].text)
        item = bench.text.iloc[n]
        text = [r.text, " ".join(w[:-1] + ["changed"]), " ".join(w[:30] + other[:40] + [f"tail{n}"]),
                " ".join(w[5:40]) + " " + item[:30] + "x" + item[31:]][n % 4]
        extra.append({"doc_id": 10_000 + n, "text": text, "lang": r.lang, "source": r.source, "n_chars": len(text)})
    docs = pd.concat([docs, pd.DataFrame(extra)], ignore_index=True)
    for name, t in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        t.to_parquet(tmp_path / f"{name}.parquet", index=False)
    tables, fitted = {}, []
    write, train = corpus_pipeline.materialize, quality_mil.train
    monkeypatch.setattr(corpus_pipeline, "materialize", lambda df, name: tables.setdefault(name, write(df, name)))
    monkeypatch.setattr(quality_mil, "train", lambda *a, **k: fitted.append(train(*a, **k)) or fitted[-1])
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    rows = {name: {r.doc_id: r for r in t.collect()} for name, t in tables.items() if "sentencepiece" not in name}
    quality, near, cut, clean = (rows[f"pipeline-{name}"] for name, _ in corpus_pipeline.STAGES[:4])

    scores = {r.doc_id: attention_score(fitted[0], passage_vectors(r.text)) for r in docs.itertuples()}
    sure = {d for d, s in scores.items() if abs(s - 0.3) > 1e-3}
    assert {d for d in quality if d in sure} == {d for d in sure if scores[d] >= 0.3}
    assert set(near) == survivors([(d, r.text) for d, r in quality.items()])
    want = kept_words([(d, r.text) for d, r in near.items()])
    assert {d: words(r.text) for d, r in cut.items()} == want
    assert all(r.n_chars == len(r.text) for r in cut.values())
    norm = lambda s: " ".join(s.split()).lower()
    items = [norm(t) for t in bench.text]
    leaks = {d for d, r in cut.items() if any(edits(p, norm(r.text)) <= int(0.05 * len(p)) for p in items)}
    assert set(clean) == set(cut) - leaks
    # the planted cases are met: rejected, near copies, repeats and passages of the benchmark
    assert len(near) < len(quality) and any(len(want[d]) < len(words(near[d].text)) for d in near) and leaks
    for d, r in list(near.items()) + list(clean.items()):
        assert (r.lang, r.source) == tuple(docs.loc[docs.doc_id == d, ["lang", "source"]].iloc[0])
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    assert set(out) == set(clean)
    for d, r in out.items():
        assert r.round_trip and len(r.ids) == r.n_ids
        assert norm(model.decode(list(r.ids))) == norm(clean[d].text)
