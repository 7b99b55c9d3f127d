"""SentencePiece encoding and decoding by shared-prefix Viterbi.

Vocabulary and scores come from a public model file.  A text is marked as the
model does it: spaces become the mark U+2581 and a mark is put in front.  It is
cut before every run of marks; no piece of more than one word exists, so the
best segmentation of the text is that of its marked words.  The best
segmentation has the greatest sum of scores; of equal sums the one whose last
piece is longest (decided from the front).  A character without a piece is
written as the byte pieces of its UTF-8 bytes, at a score below all others.

The distinct marked words of a slab of texts are sorted, which lays them out
in the depth-first order of their trie: each word keeps the forward scores of
the prefix it shares with the word before it and computes only the rest.

Decoding joins the pieces, turns marks into spaces and drops the first.  It
gives back every text exactly, but for texts that hold U+2581 itself, which
the model does not tell from a space.

Defined cases: null and empty texts have no ids (null decodes to null); texts
of any length are taken whole; extra columns pass through, columns named ids
or decoded are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mcqflow.llm import words as W

MARK = "▁"
_loaded: dict = {}


class Model:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = {int(self.pieces[i][3:-1], 16): i for i in range(n) if sp.is_byte(i)}
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: sp.get_score(i) for i in plain}
        self.trie: dict = {}  # character -> [score, id (None: no piece ends here), next characters]
        for p, i in self.ids.items():
            kids = self.trie
            for c in p:
                entry = kids.setdefault(c, [0.0, None, {}])
                kids = entry[2]
            entry[0], entry[1] = self.scores[p], i
        self.unknown = min(self.scores.values(), default=0.0) - 10.0
        raw = [b""] * n
        for i in plain:
            raw[i] = self.pieces[i].replace(MARK, " ").encode()
        for b, i in self.byte_id.items():
            raw[i] = bytes([b])
        self.raw_len = np.array([len(x) for x in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_len) - self.raw_len
        self.raw = np.frombuffer(b"".join(raw), np.uint8)


def model(path: str) -> Model:
    if path not in _loaded:
        _loaded[path] = Model(path)
    return _loaded[path]


def segment_sorted(m: Model, sorted_words):
    """Ids of each marked word; the words come in sorted order.

    For every depth of the current trie path three things are kept: the best
    score, the last piece (start and id), and the open pieces, each with the
    score at its start and its place in the vocabulary's trie.
    """
    root, unknown, byte_id = m.trie, m.unknown, m.byte_id
    best, back, last, opened = [0.0], [0], [0], [[(0.0, 0, root)]]
    prev, out = "", []
    for w in sorted_words:
        n, k, lim = len(w), 0, min(len(prev), len(w))
        while k < lim and prev[k] == w[k]:
            k += 1
        del best[k + 1:], back[k + 1:], last[k + 1:], opened[k + 1:]
        for j in range(k, n):
            c, top, at, piece, still = w[j], None, j, None, []
            for base, i, kids in opened[j]:
                e = kids.get(c)
                if e is not None:
                    score, pid, more = e
                    if pid is not None and (top is None or base + score > top):
                        top, at, piece = base + score, i, pid
                    if more:
                        still.append((base, i, more))
            if top is None:
                top = best[j] + unknown
            still.append((top, j + 1, root))
            best.append(top)
            back.append(at)
            last.append(piece)
            opened.append(still)
        seq, j = [], n
        while j:
            if last[j] is None:
                seq += [byte_id[b] for b in reversed(w[j - 1:j].encode())]
            else:
                seq.append(last[j])
            j = back[j]
        seq.reverse()
        out.append(seq)
        prev = w
    return out


def _marked(buf, off):
    """Bytes with a space put in front of every non-empty row."""
    n = np.diff(off)
    full = n > 0
    new_off = np.zeros(len(off), np.int64)
    np.cumsum(n + full, out=new_off[1:])
    out = np.empty(int(new_off[-1]), np.uint8)
    mask = np.ones(len(out), bool)
    mask[new_off[:-1][full]] = False
    out[mask] = buf
    out[~mask] = 0x20
    return out, new_off


class Encoder:
    def __init__(self, path: str, limit: int = 2_000_000):
        self.m, self.limit = model(path), limit
        self._clear()

    def _clear(self):
        self.keys, self.start, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def encode(self, buf, off):
        buf, off = _marked(buf, off)
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(len(off) - 1, np.int64)
        space = buf == 0x20
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[off[:-1][np.diff(off) > 0]] = True
        s = np.flatnonzero(cut)
        e = np.append(s[1:], len(buf))
        h = W.span_hashes(buf, s, e)
        keys, at, inv = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > self.limit:  # bounds the memory
            self._clear()
        pos = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = pos < len(self.keys)
        known[inside] = self.keys[pos[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = buf.tobytes()
            ws = [raw[a:b].decode("utf-8").replace(" ", MARK) for a, b in zip(s[at[new]].tolist(), e[at[new]].tolist())]
            order = sorted(range(len(ws)), key=ws.__getitem__)
            seqs = segment_sorted(self.m, [ws[i] for i in order])
            length = np.array([len(x) for x in seqs], np.int64)
            flat = np.fromiter((i for x in seqs for i in x), np.int32, int(length.sum()))
            start = np.cumsum(length) - length + len(self.flat)
            self.flat = np.concatenate((self.flat, flat))
            k = np.concatenate((self.keys, keys[new][order]))
            by = np.argsort(k, kind="stable")
            self.keys = k[by]
            self.start = np.concatenate((self.start, start))[by]
            self.length = np.concatenate((self.length, length))[by]
        pos = np.searchsorted(self.keys, keys)
        st, ln = self.start[pos][inv], self.length[pos][inv]
        total = np.zeros(len(h) + 1, np.int64)
        np.cumsum(ln, out=total[1:])
        return W.gather(self.flat, st, ln), np.diff(total[np.searchsorted(s, off)])


def decode(m: Model, ids, n):
    """Bytes and offsets of the texts of rows with n ids each."""
    ln = m.raw_len[ids]
    flat = W.gather(m.raw, m.raw_start[ids], ln)
    total = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(ln, out=total[1:])
    row = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=row[1:])
    off = total[row]
    full = np.diff(off) > 0
    keep = np.ones(len(flat), bool)
    keep[off[:-1][full]] = False  # the mark that encoding put in front
    return flat[keep], off - np.concatenate(([0], np.cumsum(full)))


def _task(path, text_col, out_names, schema):
    def run(batches):
        enc = Encoder(path)
        for b in batches:
            for lo, hi in W.slabs(W.text_bytes(b.column(text_col))[1]):
                c = b.slice(lo, hi - lo)
                col = c.column(text_col)
                buf, off = W.text_bytes(pc.replace_substring(col, MARK, " "))
                ids, n = enc.encode(buf, off)
                dec, doff = decode(enc.m, ids, n)
                valid = pc.is_valid(col).to_numpy(zero_copy_only=False)
                orig, ooff = W.text_bytes(col)
                o = np.concatenate(([0], np.cumsum(n)))
                made = {"n_ids": lambda: pa.array(n, pa.int64()),
                        "ids": lambda: pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(ids, pa.int32())),
                        "decoded": lambda: W.string_column(dec, doff, valid),
                        "ids_crc32": lambda: _crc(ids.astype("<u4"), o, 4),
                        "decoded_crc32": lambda: _crc(dec, doff, 1),
                        "round_trip": lambda: pa.array(_equal(orig, ooff, dec, doff), pa.bool_())}
                cols = {f.name: made[f.name]() if f.name in out_names else c.column(f.name) for f in schema}
                yield pa.RecordBatch.from_arrays([cols[f.name].cast(f.type) for f in schema], schema=schema)
    return run


def _crc(a, off, width):
    raw = memoryview(a.tobytes())
    return pa.array([zlib.crc32(raw[width * x:width * y]) for x, y in zip(off[:-1].tolist(), off[1:].tolist())], pa.int64())


def _equal(a, ao, b, bo):
    """Whether the rows of two byte columns agree."""
    same = np.diff(ao) == np.diff(bo)
    if same.all() and np.array_equal(a, b):
        return same
    ra, rb = a.tobytes(), b.tobytes()
    return np.array([bool(s) and ra[w:x] == rb[y:z] for s, w, x, y, z in zip(same, ao[:-1], ao[1:], bo[:-1], bo[1:])], bool)


_TYPES = {"n_ids": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType(),
          "ids_crc32": T.LongType(), "decoded_crc32": T.LongType(), "round_trip": T.BooleanType()}


def encode_decode(docs: DataFrame, path: str, text_col: str = "text", outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """``docs`` plus the chosen outputs: ids, decoded, n_ids, ids_crc32 (of the
    ids as little-endian 32-bit), decoded_crc32 (of the UTF-8 bytes), round_trip."""
    from pyspark.sql.pandas.types import to_arrow_schema
    docs = docs.drop(*outputs)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, _TYPES[n]) for n in outputs)])
    return docs.mapInArrow(_task(path, text_col, set(outputs), to_arrow_schema(schema)), schema)


def report(docs: DataFrame, path: str) -> DataFrame:
    return encode_decode(docs.select("doc_id", "text"), path, outputs=("n_ids", "ids_crc32", "decoded_crc32", "round_trip")).drop("text")
