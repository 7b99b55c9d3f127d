"""Quality classifier: gated attention over the passages of a document.

Every passage (32 words, the last one shorter) of the whole text is encoded as
a vector of fixed statistics (shares of symbols, capitals, digits, marks, words
per line, repeated and distinct words, word lengths, hashed byte shares).  A
document is the bag of its passages: attention weights
softmax(w . (tanh(V x) * sigmoid(U x))) weigh the hidden passage vectors, and
the weighted sum is scored by a logistic output.  All weights are learned from
document labels alone (binary cross entropy, Adam, fixed seed).

The model is fitted on a bounded sample of labelled rows (``MAX_FIT`` documents
expected, chosen by a hash of doc_id, so the choice does not depend on the
partitioning) whose crc32(doc_id as text) mod 5 is not 0, with every passage
of a sampled document; if these have more than ``MAX_PASSAGES`` passages, the
hash range is narrowed to hold so many in expectation.  Scoring reads every
passage of every document.  Only text enters a score.

Defined cases: null and empty texts score as a bag of one zero passage; null
quality labels and null doc_ids are not used for fitting; without labelled
rows of both classes the score is the share of label 1 (one half without any);
repeated label rows of a document: the greatest quality counts; repeated
doc_ids: the text with the least hash is used for fitting, null texts last,
and every row is scored; extra columns pass through, columns named score or predicted are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mcqflow.llm import words as W
from mcqflow.session import materialize

PASSAGE = 32
MAX_FIT = 6000
MAX_PASSAGES = 400_000  # 136 bytes each on the driver, some copies while fitting
HIDDEN, GATE = 24, 12
EPOCHS = 60
THRESHOLD = 0.3
_FOLD = 16  # hashed byte classes

_CLASS = {
    "symbol": b"#*$%&|<>", "mark": b"!?", "stop": b".,;:", "digit": b"0123456789",
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "high": bytes(range(128, 256)),
    "bracket": b"()[]{}=/\\_@^~+", "hyphen": b"-'\"", "line": b"\n",
}
_LUT = np.zeros((len(_CLASS), 256), bool)
for _i, _b in enumerate(_CLASS.values()):
    _LUT[_i, list(_b)] = True
N_FEATURES = len(_CLASS) + 8 + _FOLD


def encode(buf, off):
    """Passage vectors of all rows and each row's first passage (at least one a row)."""
    starts, ends, first = W.word_spans(buf, off)
    h = W.span_hashes(buf, starts, ends)
    n_words = np.diff(first)
    bags = np.maximum(1, -(-n_words // PASSAGE))
    pfirst = np.concatenate(([0], np.cumsum(bags)))
    x = np.zeros((int(pfirst[-1]), N_FEATURES), np.float32)
    if not len(starts):
        return x, pfirst
    row = np.repeat(np.arange(len(n_words)), n_words)
    pas = pfirst[row] + (np.arange(len(starts)) - first[row]) // PASSAGE
    lead = np.flatnonzero(np.concatenate(([True], pas[1:] != pas[:-1])))  # first word of each passage
    live = pas[lead]
    count = np.diff(np.append(lead, len(starts)))
    a = starts[lead]
    z = np.append(ends[lead[1:] - 1], ends[-1])  # last byte of each passage
    span = (z - a).astype(np.float32)
    cum = np.zeros(len(buf) + 1, np.int32)
    for k in range(len(_CLASS)):
        np.cumsum(_LUT[k][buf], out=cum[1:])
        x[live, k] = (cum[z] - cum[a]) / span
    length = (ends - starts).astype(np.float32)
    mean = np.add.reduceat(length, lead) / count
    c = len(_CLASS)
    x[live, c] = mean / 10
    x[live, c + 1] = np.sqrt(np.maximum(0, np.add.reduceat(length * length, lead) / count - mean ** 2)) / 5
    # distinct words and neighbours' equality inside the passage
    key = W.mix(h ^ (pas.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    fresh = np.ones(len(key), bool)
    fresh[order[1:]] = key[order][1:] != key[order][:-1]
    x[live, c + 2] = np.add.reduceat(fresh.astype(np.float32), lead) / count
    same = np.zeros(len(h), np.float32)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    x[live, c + 3] = np.add.reduceat(same, lead) / count
    x[live, c + 4] = np.log1p(count) / np.log1p(PASSAGE)
    # words met before in the document, and five words in a row met before
    for col, keys in ((c + 5, h), (c + 6, np.append(W.windows(h, 5), np.zeros(min(4, len(h)), np.uint64))[:len(h)])):
        k = W.mix(keys ^ (row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        order = np.argsort(k, kind="stable")
        again = np.zeros(len(k), np.float32)
        again[order[1:]] = k[order][1:] == k[order][:-1]
        if col == c + 6:
            again *= W.within(first, len(h), 5)
        x[live, col] = np.add.reduceat(again, lead) / count
    x[live, c + 7] = np.log1p(n_words[row[lead]]) / 10
    fold = np.add.reduceat(np.eye(_FOLD, dtype=np.float32)[(h >> np.uint64(60)).astype(np.int64)], lead, axis=0)
    x[live, c + 8:] = fold / count[:, None] * 4
    return x, pfirst


def _forward(p, x, pfirst):
    lead, n = pfirst[:-1], np.diff(pfirst)
    hid = np.tanh(x @ p["W"] + p["c"])
    t, g = np.tanh(x @ p["V"]), 1 / (1 + np.exp(-(x @ p["U"])))
    e = (t * g) @ p["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, lead), n))
    att = e / np.repeat(np.add.reduceat(e, lead), n)
    bag = np.add.reduceat(hid * att[:, None], lead, axis=0)
    s = 1 / (1 + np.exp(-(bag @ p["o"] + p["b"])))
    return s, (hid, t, g, att, bag)


def fit(x, pfirst, y, epochs=EPOCHS, seed=11):
    """Weights from bags (x, pfirst) and 0/1 labels, or the label share if one class is missing."""
    if not len(y) or y.min() == y.max():
        return {"share": float(y.mean()) if len(y) else 0.5}
    rng = np.random.RandomState(seed)
    mu, sd = x.mean(0), x.std(0) + 1e-3
    d = x.shape[1]
    p = {"W": rng.randn(d, HIDDEN) / np.sqrt(d), "c": np.zeros(HIDDEN), "V": rng.randn(d, GATE) / np.sqrt(d),
         "U": rng.randn(d, GATE) / np.sqrt(d), "w": rng.randn(GATE) / np.sqrt(GATE),
         "o": rng.randn(HIDDEN) / np.sqrt(HIDDEN), "b": np.zeros(1)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    z = np.clip((x - mu) / sd, -6, 6).astype(np.float32)
    step = 0
    for ep in range(epochs):
        for ids in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
            n = (pfirst[ids + 1] - pfirst[ids])
            bx = W.gather(z, pfirst[ids], n)
            bf = np.concatenate(([0], np.cumsum(n)))
            s, (hid, t, g, att, bag) = _forward(p, bx, bf)
            rep = np.repeat(np.arange(len(ids)), n)
            ds = ((s - y[ids]) / len(ids)).astype(np.float32)
            gr = {"o": bag.T @ ds, "b": ds.sum(keepdims=True)}
            dbag = ds[:, None] * p["o"]
            datt = (dbag[rep] * hid).sum(1)
            dhid = dbag[rep] * att[:, None] * (1 - hid ** 2)
            de = att * (datt - np.add.reduceat(datt * att, bf[:-1])[rep])
            gr["W"], gr["c"] = bx.T @ dhid, dhid.sum(0)
            gr["w"] = (t * g).T @ de
            dtg = de[:, None] * p["w"]
            gr["V"] = bx.T @ (dtg * g * (1 - t ** 2))
            gr["U"] = bx.T @ (dtg * t * g * (1 - g))
            step += 1
            rate = 0.01 * (1 - 0.9 * ep / epochs)
            for k in p:
                gk = gr[k] + 1e-4 * p[k]
                m[k] = 0.9 * m[k] + 0.1 * gk
                v2[k] = 0.999 * v2[k] + 0.001 * gk ** 2
                p[k] = (p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return p | {"mu": mu.astype(np.float32), "sd": sd.astype(np.float32)}


def score(p, x, pfirst):
    if "share" in p:
        return np.full(len(pfirst) - 1, p["share"])
    z = np.clip((x - p["mu"]) / p["sd"], -6, 6).astype(np.float32)
    return _forward(p, z, pfirst)[0].astype(np.float64)


def _encode_task(batches):
    for b in batches:
        buf, off = W.text_bytes(b.column("text"))
        for lo, hi in W.slabs(off):
            x, pf = encode(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id").slice(lo, hi - lo), "quality": b.column("quality").slice(lo, hi - lo).cast(pa.int32()),
                "bag": pa.array([x[a:z].astype("<f4").tobytes() for a, z in zip(pf[:-1], pf[1:])], pa.binary())})


def train(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT, holdout_mod: int = 5, max_passages: int = MAX_PASSAGES) -> dict:
    """Fit on the bounded sample; the driver receives at most the sample's bags."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % holdout_mod
    own = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold != 0))
           .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    n = own.count()
    spot, upto = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), 1 << 30
    if n > max_fit:  # keep a hash range that holds max_fit rows in expectation
        upto = int(upto * max_fit / n)
        own = own.where(spot < upto)
    # the sample's ids and labels: about max_fit rows of 12 bytes, a proven broadcast bound
    # one text a doc_id, so a repeated id does not rule the fit or fill the driver
    first = F.struct(F.col("text").isNull(), F.xxhash64("text"))
    made = materialize(docs.select("doc_id", "text").join(F.broadcast(own), "doc_id")
                       .groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min_by("text", first).alias("text"))
                       .mapInArrow(_encode_task, "doc_id long, quality int, bag binary"), "quality-bags")
    passages = (made.agg(F.sum(F.octet_length("bag").cast("long"))).first()[0] or 0) // (4 * N_FEATURES)
    if passages > max_passages:  # fewer documents, each whole
        made = made.where(spot < int(upto * max_passages / passages))
    rows = made.collect()
    rows.sort(key=lambda r: (r.doc_id, r.bag))
    bags = [np.frombuffer(r.bag, "<f4").reshape(-1, N_FEATURES) for r in rows]
    y = np.array([float(r.quality > 0) for r in rows], np.float32)
    pf = np.concatenate(([0], np.cumsum([len(x) for x in bags]))).astype(np.int64)
    return fit(np.concatenate(bags) if bags else np.zeros((0, N_FEATURES), np.float32), pf, y)


def _score_task(params, schema):
    def run(batches):
        for b in batches:
            for lo, hi in W.slabs(W.text_bytes(b.column("text"))[1]):
                c = b.slice(lo, hi - lo)
                s = score(params, *encode(*W.text_bytes(c.column("text"))))
                s = np.clip(s, 0.0, 1.0)
                new = {"score": pa.array(s), "predicted": pa.array((s >= THRESHOLD).astype(np.int32))}
                yield pa.RecordBatch.from_arrays([new.get(f.name, None) if f.name in new else c.column(f.name).cast(f.type) for f in schema], schema=schema)
    return run


def classify(docs: DataFrame, params: dict) -> DataFrame:
    """``docs`` plus score (0 to 1) and predicted."""
    from pyspark.sql.pandas.types import to_arrow_schema
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(_score_task(params, to_arrow_schema(schema)), schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    params = train(docs, labels)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return classify(docs.select("doc_id", "text"), params).select("doc_id", held.alias("held_out"), "score", "predicted")
