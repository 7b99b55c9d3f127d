"""Token ids as flat binary files with 64-bit document offsets.

Layout of a store (a folder in shared storage):

  part-00000.ids   token ids of the part's documents, back to back, as
                   little-endian unsigned 16-bit (vocabulary up to 65,536)
                   or 32-bit integers
  part-00000.idx   int64 little-endian: document count n, then n + 1 offsets
                   (ids before each document, counted in the part), then n
                   document ids, then n flags (0: the document id is null)
  manifest         Parquet, one row a part: part, n_docs, n_tokens

Parts are in ascending document order.  The global position of a part (its
base) is the prefix sum of the token counts before it, taken over the manifest.
Documents are range-partitioned by doc_id; each task encodes its texts and
writes its two files under temporary names, then renames them, so a repeated
task leaves the same files.  Reading maps the files into memory.

Encoding.  The tokenizer normalises and splits a text into letter runs, single
digits and runs of other characters, and the merges work inside these pieces.
A task therefore encodes each distinct piece (cut at white space and between
ASCII letters or digits and the marks in ``_CUT``) once and lays the ids out by
position.  Pieces of ASCII letters are one piece for the merges too and go to
them directly; their last token ends in the model's word-end suffix, which
tells where each ends.  Texts with ``<|``, which may hold a special token's
string, are encoded whole.

Defined cases: null text is an empty text (its ids are the end id alone); null
doc_id sorts last; rows with equal doc_id are ordered by text hash; very long
texts are one document; an empty table gives an empty store; only doc_id and
text are read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mcqflow.llm import words as W
from mcqflow.session import scratch_path

END_ID = 2
_CUT = np.zeros(256, bool)
_CUT[[ord(c) for c in ",.!%$&*#|;:?()"]] = True  # marks: never part of a letter run, a digit or a contraction
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True  # ASCII letters and digits
_ALPHA = np.zeros(256, bool)
_ALPHA[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32  # the tokenizer lowers letters itself; done here so that pieces coincide
_BATCH = 100  # pieces in one call's string
CHUNK_BYTES = 4 << 20  # texts encoded at a time
_loaded: dict = {}


def _tokenizer(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        tok = Tokenizer.from_file(path)
        merges = Tokenizer(tok.model)  # the same merges on pieces that need no normalising or splitting
        merges.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        vocab = tok.get_vocab()
        ends = np.zeros(max(vocab.values()) + 1, bool)
        ends[[i for s, i in vocab.items() if s.endswith("</w>")]] = True
        _loaded[path] = (tok, vocab["<|endoftext|>"], merges, ends)
    return _loaded[path]


def _pieces(buf, off):
    """Spans that can be encoded alone: words, cut between a run of marks and the rest."""
    starts, ends, first = W.word_spans(buf, off)
    if not len(starts):
        return starts, ends, first
    cut, plain = _CUT[buf], _PLAIN[buf]
    edge = np.zeros(len(buf), bool)
    # both sides of an edge are in the word: neither a mark nor a plain byte is white space
    edge[1:] = (cut[1:] & plain[:-1]) | (plain[1:] & cut[:-1])
    edge[off[:-1][off[:-1] < len(buf)]] = False
    edge[starts] = True
    s = np.flatnonzero(edge)
    # a piece ends at the next piece's start or at its word's end
    word_end = ends[np.searchsorted(starts, s, "right") - 1]
    nxt = np.append(s[1:], len(buf))
    return s, np.minimum(word_end, nxt), np.searchsorted(s, off)


class Encoder:
    """Encodes texts of a task; remembers the ids of the pieces it has met."""

    def __init__(self, path: str, limit: int = 3_000_000):
        self.tok, self.sep, self.merges, self.ends = _tokenizer(path)
        self.limit = limit
        self._clear()

    def _clear(self):
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _whole(self, strings):
        """Ids and lengths of any pieces, told apart by a special token between them."""
        sep = "<|endoftext|>"
        texts = [sep.join(strings[i:i + _BATCH]) for i in range(0, len(strings), _BATCH)]
        lens, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for e in self.tok.encode_batch_fast(texts, add_special_tokens=False):
            a = np.array(e.ids, np.uint32)
            cuts = np.flatnonzero(a == self.sep)
            lens.append(np.diff(np.concatenate(([-1], cuts, [len(a)]))) - 1)
            ids.append(a[a != self.sep])
        return np.concatenate(ids), np.concatenate(lens)

    def _letters(self, strings):
        """Ids and lengths of pieces of ASCII letters."""
        texts = ["\n".join(strings[i:i + _BATCH]) for i in range(0, len(strings), _BATCH)]
        ids = [np.array(e.ids, np.uint32) for e in self.merges.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.uint32), *ids])
        return ids, np.diff(np.concatenate(([-1], np.flatnonzero(self.ends[ids]))))

    def _learn(self, keys, strings, letters):
        parts = ((self._letters, letters), (self._whole, ~letters))
        made = [(keys[m], *f([strings[i] for i in np.flatnonzero(m)])) for f, m in parts if m.any()]
        k = np.concatenate([self.keys, *(x[0] for x in made)])
        length = np.concatenate([x[2] for x in made])
        start = np.cumsum(length) - length + len(self.flat)
        self.flat = np.concatenate([self.flat, *(x[1] for x in made)])
        order = np.argsort(k, kind="stable")
        self.keys = k[order]
        self.start = np.concatenate((self.start, start))[order]
        self.length = np.concatenate((self.length, length))[order]

    def encode(self, buf, off):
        """(ids, ids in each row) of the rows."""
        low = _LOWER[buf]
        s, e, first = _pieces(low, off)
        h = W.span_hashes(low, s, e)
        keys, at, inv = np.unique(h, return_index=True, return_inverse=True)
        pos = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = pos < len(self.keys)
        known[inside] = self.keys[pos[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = low.tobytes()
            if len(self.keys) > self.limit:  # bounds the memory; forgotten pieces are encoded again
                self._clear()
                new = np.arange(len(keys))
            a, b = s[at[new]], e[at[new]]
            plain = np.zeros(len(low) + 1, np.int64)
            np.cumsum(_ALPHA[low], out=plain[1:])
            self._learn(keys[new], [raw[x:y].decode("utf-8") for x, y in zip(a.tolist(), b.tolist())], plain[b] - plain[a] == b - a)
        pos = np.searchsorted(self.keys, keys)
        st, ln = self.start[pos][inv], self.length[pos][inv]
        total = np.zeros(len(h) + 1, np.int64)
        np.cumsum(ln, out=total[1:])
        return W.gather(self.flat, st, ln), np.diff(total[first])

    def encode_rows(self, col):
        """As ``encode`` over an Arrow column; rows with ``<|`` go to the tokenizer whole."""
        odd = pc.fill_null(pc.match_substring(col, "<|"), False).to_numpy(zero_copy_only=False)
        buf, off = W.text_bytes(pc.if_else(pa.array(odd), pa.scalar("", col.type), col) if odd.any() else col)
        parts, counts = [], []
        for lo, hi in W.slabs(off, 2 * W.SLAB_BYTES):
            ids, n = self.encode(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            parts.append(ids)
            counts.append(n)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        if odd.any():
            cut = np.cumsum(n) - n
            pieces, last = [], 0
            for r in np.flatnonzero(odd):
                whole = np.array(self.tok.encode(col[int(r)].as_py(), add_special_tokens=False).ids, np.uint32)
                pieces += [ids[last:cut[r]], whole]
                last, n[r] = cut[r], len(whole)
            ids = np.concatenate([*pieces, ids[last:]])
        return ids, n


def _with_end(ids, n, end_id):
    """Append the end id to every row."""
    out = np.empty(len(ids) + len(n), np.uint32)
    ends = np.cumsum(n + 1) - 1
    mask = np.ones(len(out), bool)
    mask[ends] = False
    out[mask] = ids
    out[ends] = end_id
    return out, n + 1


def _fs(folder: str):
    """File system and path of a folder (file: or any Arrow file system)."""
    from pyarrow import fs
    if urlparse(folder).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(folder).path
    return fs.FileSystem.from_uri(folder)


def _writer(path: str, folder: str, end_id: int, dtype: str):
    def run(batches):
        part = TaskContext.get().partitionId()
        enc = Encoder(path)
        fs, root = _fs(folder)
        tmp = f"{root}/_tmp-{part:05d}-{uuid.uuid4().hex}"
        docs, valid, lens, n_tokens = [], [], [], 0
        with fs.open_output_stream(f"{tmp}.ids") as out:
            for b in batches:
                for lo, hi in W.slabs(W.text_bytes(b.column(1))[1], CHUNK_BYTES):
                    c = b.slice(lo, hi - lo)
                    ids, n = _with_end(*enc.encode_rows(c.column(1)), end_id)
                    if len(ids) and int(ids.max()) > np.iinfo(dtype).max:
                        raise ValueError(f"token id {int(ids.max())} does not fit {dtype}")
                    out.write(ids.astype(dtype).tobytes())
                    docs.append(pc.fill_null(c.column(0), 0).to_numpy(zero_copy_only=False).astype("<i8"))
                    valid.append(pc.is_valid(c.column(0)).to_numpy(zero_copy_only=False).astype("<i8"))
                    lens.append(n)
                    n_tokens += len(ids)
        n_docs = sum(map(len, docs))
        if not n_docs:
            fs.delete_file(f"{tmp}.ids")
            return
        head = np.concatenate([[n_docs], [0], np.cumsum(np.concatenate(lens)), *docs, *valid]).astype("<i8")
        with fs.open_output_stream(f"{tmp}.idx") as out:
            out.write(head.tobytes())
        for kind in ("ids", "idx"):
            fs.move(f"{tmp}.{kind}", f"{root}/part-{part:05d}.{kind}")
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_docs": pa.array([n_docs], pa.int64()),
                                          "n_tokens": pa.array([n_tokens], pa.int64())})
    return run


def write_store(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, dtype: str = "<u2",
                id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` in ascending doc_id order into a store."""
    fs, root = _fs(folder)
    fs.create_dir(root, recursive=True)
    # fewer, larger files than shuffle partitions: a task then meets more of its pieces again
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 2)
    keys = [F.col("id").asc_nulls_last(), F.col("tie").asc()]
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .withColumn("tie", F.xxhash64("text"))
            .repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("id", "text"))
    (rows.mapInArrow(_writer(tokenizer, folder, end_id, dtype), "part int, n_docs long, n_tokens long")
     .write.parquet(f"{folder}/manifest"))


def _mapped(folder: str, part: int, kind: str, dtype: str):
    """A file as an array: memory-mapped where the folder is a mounted one."""
    fs, root = _fs(folder)
    name = f"{root}/part-{part:05d}.{kind}"
    if urlparse(folder).scheme in ("", "file"):
        return np.memmap(name, dtype=dtype, mode="r")
    with fs.open_input_file(name) as f:
        return np.frombuffer(f.read_buffer(), dtype)


def _reader(folder: str, dtype: str, with_ids: bool):
    def run(batches):
        for b in batches:
            for part, base in zip(b.column("part").to_pylist(), b.column("base").to_pylist()):
                idx = _mapped(folder, part, "idx", "<i8")
                ids = _mapped(folder, part, "ids", dtype)
                n = int(idx[0])
                off = np.asarray(idx[1:n + 2])
                doc, valid = np.asarray(idx[n + 2:2 * n + 2]), np.asarray(idx[2 * n + 2:])
                for lo, hi in W.slabs(off, CHUNK_BYTES):
                    a = np.asarray(ids[off[lo]:off[hi]]).astype("<u4")
                    o = off[lo:hi + 1] - off[lo]
                    raw = memoryview(a).cast("B")
                    cols = {"doc_id": pa.array(doc[lo:hi], pa.int64(), mask=valid[lo:hi] == 0),
                            "start": pa.array(base + off[lo:hi], pa.int64()),
                            "n_tokens": pa.array(np.diff(o), pa.int64()),
                            "ids_crc32": pa.array([zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(o[:-1], o[1:])], pa.int64())}
                    if with_ids:
                        cols["ids"] = pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(a.astype(np.int64), pa.int64()))
                    yield pa.RecordBatch.from_pydict(cols)
    return run


def read_store(spark: SparkSession, folder: str, dtype: str = "<u2", with_ids: bool = False) -> DataFrame:
    """Documents of a store: doc_id, start, n_tokens, ids_crc32 (and ids)."""
    manifest = spark.read.schema("part int, n_docs long, n_tokens long").parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    based = manifest.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base")).repartition(parts)
    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return based.mapInArrow(_reader(folder, dtype, with_ids), out)


def report(docs: DataFrame, tokenizer: str) -> DataFrame:
    folder = scratch_path(docs.sparkSession, "token-store")
    write_store(docs, folder, tokenizer)
    return read_store(docs.sparkSession, folder)
