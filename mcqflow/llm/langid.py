"""Language identification by segmentation-marginalised unigrams.

A fixed public vocabulary gives the pieces.  For each language a probability
of every piece is learned; the probability of a word is the sum over all its
segmentations into pieces, found by the forward algorithm, and a text's score
is the product over its words (words marked at their start, as the vocabulary
marks them).  The language with the greatest posterior wins.

Learning: labelled rows (a language, a doc_id, a letter in the text, and
crc32(doc_id as text) mod 3 not 1) are counted by language; the counts are the
prior.  Word counts come from a bounded sample of each language (``QUOTA``
documents of it expected, all if it has no more, and always the row with the
least hash of doc_id, so no labelled language is without words), then
expectation-maximisation: expected
piece counts from the forward and backward sums, by Spark over the counted
words; only the sums (languages x vocabulary) reach the driver.

Scoring: each task computes the forward sums of its distinct words once and
adds them up by document.  Whole texts are scored.

Defined cases: null text or text without a letter: ``und``, score 0; a
character outside the vocabulary counts the same for every language; equal
posteriors: the alphabetically first language; without training rows every
text is ``und``; extra columns pass through, columns named lang_pred or score
are replaced; very long words are rescaled, so nothing underflows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mcqflow.llm import words as W
from mcqflow.session import materialize

QUOTA = 1000  # documents of each language in the fitted sample, in expectation
ROUNDS = 3
SMOOTH = 0.01  # pseudo-count of every piece
LONG = 40  # words of more characters are summed with scaling
UNKNOWN = 1e-7  # probability of a character outside the vocabulary
MARK = "▁"
_A = np.uint64(0x9E3779B97F4A7C15)
_vocab: dict = {}


def vocabulary(path: str) -> list[str]:
    """The pieces of a SentencePiece model file, without byte and control pieces."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]


class Lattice:
    """Finds the pieces in words given as code points."""

    def __init__(self, pieces):
        self.n = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        keys = np.zeros(self.n, np.uint64)
        for k, p in enumerate(pieces):
            h = 0
            for ch in p:
                h = (h * int(_A) + ord(ch) + 1) & 0xFFFFFFFFFFFFFFFF
            keys[k] = h
        keys = W.mix(keys)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[keys >> np.uint64(44)] = True

    def find(self, h):
        """Piece number of each hash, or -1."""
        out = np.full(len(h), -1, np.int64)
        maybe = np.flatnonzero(self.seen[h >> np.uint64(44)])
        pos = np.searchsorted(self.keys, h[maybe])
        pos[pos == self.n] = 0
        ok = self.keys[pos] == h[maybe]
        out[maybe[ok]] = self.order[pos[ok]]
        return out

    def edges(self, c):
        """Pieces ending after each column of words ``c`` (rows x length):
        per end column a list of (length, rows, pieces)."""
        n_rows, n = c.shape
        out = [[] for _ in range(n + 1)]
        single = np.zeros((n_rows, n), bool)
        h = np.zeros((n_rows, n), np.uint64)
        x = c.astype(np.uint64) + np.uint64(1)
        for size in range(1, min(self.longest, n) + 1):
            # hash of the piece of this size that ends in each column
            prev = h
            h = np.zeros_like(prev)
            h[:, size - 1:] = (prev[:, size - 2:-1] * _A if size > 1 else 0) + x[:, size - 1:]
            f = self.find(W.mix(h[:, size - 1:]).ravel()).reshape(n_rows, -1)
            rows, col = np.nonzero(f >= 0)
            piece = f[rows, col]
            if size == 1:
                single[rows, col] = True
            by = np.argsort(col, kind="stable")
            cut = np.searchsorted(col[by], np.arange(f.shape[1] + 1))
            for j in range(f.shape[1]):
                if cut[j] < cut[j + 1]:
                    sel = by[cut[j]:cut[j + 1]]
                    out[j + size].append((size, rows[sel], piece[sel]))
        return out, ~single


def forward(lat, c, prob):
    """Forward sums of all words: (alpha per column with scales, log totals).
    ``prob``: pieces x languages."""
    n_rows, n = c.shape
    langs = prob.shape[1]
    edges, unknown = lat.edges(c)
    alpha = np.zeros((n + 1, n_rows, langs))
    alpha[0] = 1.0
    scale = np.zeros((n_rows, langs))
    for j in range(1, n + 1):
        a = alpha[j]
        for size, rows, piece in edges[j]:
            a[rows] += alpha[j - size, rows] * prob[piece]
        u = np.flatnonzero(unknown[:, j - 1])
        if len(u):
            a[u] += alpha[j - 1, u] * UNKNOWN
        if n > LONG and j % 8 == 0:  # rescale the columns that later ones read
            top = np.maximum(a, 1e-290)
            lo = max(0, j - lat.longest)
            alpha[lo:j + 1] /= top
            scale += np.log(top)
    return edges, unknown, alpha, np.log(np.maximum(alpha[n], 1e-290)) + scale


def _blocks(words, langs=1):
    """Marked words of equal length as code-point matrices: (row numbers, matrix)."""
    lens = np.array([len(w) for w in words], np.int64) + 1
    order = np.argsort(lens, kind="stable")
    cut = np.flatnonzero(np.diff(lens[order])) + 1
    for idx in np.split(order, cut) if len(order) else []:
        n = int(lens[idx[0]])
        step = max(1, 400_000 // (n * max(1, langs // 4)))  # bounds the memory
        for a in range(0, len(idx), step):
            part = idx[a:a + step]
            flat = np.frombuffer("".join([MARK + words[i] for i in part.tolist()]).encode("utf-32-le"), np.uint32)
            yield part, flat.reshape(len(part), n)


def word_scores(lat, words, prob):
    """log P(word | language), words x languages."""
    out = np.zeros((len(words), prob.shape[1]))
    for idx, c in _blocks(words, prob.shape[1]):
        out[idx] = forward(lat, c, prob)[3]
    return out


def _expected_long(lat, c, counts, prob, into):
    """As ``expected`` for long words, in logarithms, so that no sum underflows."""
    edges, unknown = lat.edges(c)
    n_rows, n = c.shape
    logp, none = np.log(prob), np.log(UNKNOWN)
    a = np.full((n + 1, n_rows), -np.inf)
    b = a.copy()
    a[0] = b[n] = 0.0
    for j in range(1, n + 1):
        for size, rows, piece in edges[j]:  # a row has one piece of a size at a column
            a[j, rows] = np.logaddexp(a[j, rows], a[j - size, rows] + logp[piece])
        u = unknown[:, j - 1]
        a[j, u] = np.logaddexp(a[j, u], a[j - 1, u] + none)
    for j in range(n, 0, -1):
        for size, rows, piece in edges[j]:
            b[j - size, rows] = np.logaddexp(b[j - size, rows], b[j, rows] + logp[piece])
        u = unknown[:, j - 1]
        b[j - 1, u] = np.logaddexp(b[j - 1, u], b[j, u] + none)
    for j in range(1, n + 1):
        for size, rows, piece in edges[j]:
            x = np.exp(a[j - size, rows] + logp[piece] + b[j, rows] - a[n, rows])
            into += np.bincount(piece, x * counts[rows], minlength=len(into))


def expected(lat, words, counts, prob, into):
    """Add the expected piece counts of counted words of one language."""
    for idx, c in _blocks(words):
        if c.shape[1] > LONG:
            _expected_long(lat, c, counts[idx], prob[:, 0], into)
            continue
        edges, unknown, alpha, _ = forward(lat, c, prob)
        n = c.shape[1]
        beta = np.zeros((n + 1, len(idx), 1))
        beta[n] = 1.0
        for j in range(n, 0, -1):
            for size, rows, piece in edges[j]:
                beta[j - size, rows] += prob[piece] * beta[j, rows]
            u = np.flatnonzero(unknown[:, j - 1])
            if len(u):
                beta[j - 1, u] += UNKNOWN * beta[j, u]
        z = np.maximum(alpha[n], 1e-290)
        for j in range(1, n + 1):
            for size, rows, piece in edges[j]:
                x = alpha[j - size, rows] * prob[piece] * beta[j, rows] / z[rows]
                into += np.bincount(piece, x[:, 0] * counts[idx][rows], minlength=len(into))


def _lattice(path):
    if path not in _vocab:
        _vocab[path] = Lattice(vocabulary(path))
    return _vocab[path]


def _words_of(buf, starts, ends, pick):
    raw = buf.tobytes()
    return [raw[a:b].decode("utf-8") for a, b in zip(starts[pick].tolist(), ends[pick].tolist())]


def _count_task(batches):
    for b in batches:
        text, all_off = W.text_bytes(b.column("text"))
        all_langs = np.array(b.column("lang").to_pylist(), object)
        for lo, hi in W.slabs(all_off, 4 * W.SLAB_BYTES):
            buf, off, langs = text[all_off[lo]:all_off[hi]], all_off[lo:hi + 1] - all_off[lo], all_langs[lo:hi]
            s, e, h, first = W.scan(buf, off)
            row_lang = np.repeat(langs, np.diff(first))
            for lang in sorted(set(langs)):
                own = np.flatnonzero(row_lang == lang)
                _, at, n = np.unique(h[own], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()),
                                                  "word": pa.array(_words_of(buf, s, e, own[at]), pa.string()), "n": pa.array(n, pa.int64())})


def _expect_task(path, langs, probs):
    def run(batches):
        lat = _lattice(path)
        sums = np.zeros((len(langs), lat.n))
        for b in batches:
            lang = np.array(b.column("lang").to_pylist(), object)
            word = np.array(b.column("word").to_pylist(), object)
            n = b.column("n").to_numpy(zero_copy_only=False).astype(float)
            for k, name in enumerate(langs):
                own = lang == name
                expected(lat, list(word[own]), n[own], probs[:, k:k + 1], sums[k])
        for k, name in enumerate(langs):
            i = np.flatnonzero(sums[k] > 0)
            yield pa.RecordBatch.from_pydict({"k": pa.array(np.full(len(i), k), pa.int32()), "piece": pa.array(i, pa.int32()), "x": pa.array(sums[k][i])})
    return run


def train(docs: DataFrame, path: str, quota: int = QUOTA, rounds: int = ROUNDS) -> dict:
    """Piece probabilities and prior of every language that has a labelled row."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    own = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold != 1) & has_letter())
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    rows = own.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(spot).alias("least")).collect()  # one row a language
    share = {r.lang: r.n for r in rows}
    langs = sorted(share)
    upto = [(r.lang, max(r.least, int((1 << 30) * min(1.0, quota / r.n)) - 1)) for r in rows]
    limits = docs.sparkSession.createDataFrame(upto, "lang string, __upto long")
    # one row a language, a proven broadcast bound
    own = own.join(F.broadcast(limits), "lang").where(spot <= F.col("__upto"))
    counted = materialize(own.select("lang", "text").mapInArrow(_count_task, "lang string, word string, n long")
                          .groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    size = len(vocabulary(path))
    probs = np.full((size, len(langs)), 1.0 / size)
    for _ in range(rounds if langs else 0):
        sums = np.full((size, len(langs)), SMOOTH)
        # languages x vocabulary rows at most
        for r in (counted.mapInArrow(_expect_task(path, langs, probs), "k int, piece int, x double")
                  .groupBy("k", "piece").agg(F.sum("x").alias("x")).collect()):
            sums[r.piece, r.k] += r.x
        probs = sums / sums.sum(0)
    total = sum(share.values()) or 1
    return {"langs": langs, "probs": probs.astype(np.float64), "prior": np.array([share[x] / total for x in langs])}


def _score_task(path, model, schema):
    langs, probs = model["langs"], model["probs"]
    prior = np.log(np.maximum(model["prior"], 1e-12))

    def run(batches):
        lat = _lattice(path)
        known, scores = np.zeros(0, np.uint64), np.zeros((0, len(langs)))
        for b in batches:
            for lo, hi in W.slabs(W.text_bytes(b.column("__text"))[1], 4 * W.SLAB_BYTES):
                c = b.slice(lo, hi - lo)
                buf, off = W.text_bytes(c.column("__text"))
                s, e, h, first = W.scan(buf, off)
                keys, at, inv = np.unique(h, return_index=True, return_inverse=True)
                if len(known) * len(langs) > 6_000_000:  # bounds the memory
                    known, scores = known[:0], scores[:0]
                pos = np.searchsorted(known, keys)
                have = np.zeros(len(keys), bool)
                inside = pos < len(known)
                have[inside] = known[pos[inside]] == keys[inside]
                new = np.flatnonzero(~have)
                if len(new):
                    fresh = word_scores(lat, _words_of(buf, s, e, at[new]), probs)
                    k = np.concatenate((known, keys[new]))
                    order = np.argsort(k, kind="stable")
                    known, scores = k[order], np.concatenate((scores, fresh))[order]
                row = np.repeat(np.arange(len(off) - 1), np.diff(first))
                per = scores[np.searchsorted(known, keys)][inv] if len(h) else np.zeros((0, len(langs)))
                tot = np.stack([np.bincount(row, per[:, k], minlength=len(off) - 1) for k in range(len(langs))], 1) + prior
                tot -= tot.max(1, keepdims=True)
                p = np.exp(tot)
                p /= p.sum(1, keepdims=True)
                best = p.argmax(1)
                ok = c.column("__letter").to_numpy(zero_copy_only=False)
                new = {"lang_pred": pa.array([langs[k] if x else "und" for k, x in zip(best, ok)], pa.string()),
                       "score": pa.array(np.where(ok, p[np.arange(len(p)), best], 0.0))}
                yield pa.RecordBatch.from_arrays([new[f.name] if f.name in new else c.column(f.name).cast(f.type) for f in schema], schema=schema)
    return run


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: dict, path: str, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) plus lang_pred and score."""
    from pyspark.sql.pandas.types import to_arrow_schema
    kept = [f for f in docs.drop("lang_pred", "score").schema.fields if keep is None or f.name in keep]
    cols = [f.name for f in kept]
    if not model["langs"]:
        return docs.select(*cols, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return (docs.select(*cols, F.col(text_col).alias("__text"), has_letter(text_col).alias("__letter"))
            .mapInArrow(_score_task(path, model, to_arrow_schema(schema)), schema))


def report(docs: DataFrame, path: str) -> DataFrame:
    model = train(docs.select("doc_id", "text", "lang"), path)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return (identify(docs.select("doc_id", "text"), model, path, keep=("doc_id",))
            .select("doc_id", held.alias("held_out"), "lang_pred", "score"))
