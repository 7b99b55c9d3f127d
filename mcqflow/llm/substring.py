"""Substring dedup by level-wise doubling.

A window of 20 consecutive words is removed where its word sequence also
starts earlier (smaller doc_id; same document: earlier start).  Windows are
found level by level: windows of 5 words that occur once only can start no
repeated window of 10, so only windows whose two halves both repeat are
extended to 10 words, and of these only the repeated ones to 20.  The rounds
end at the window length or when no candidate survives.

How a round runs.  Documents are dealt once to buckets by a hash of
(doc_id, text); this shuffle of the texts is the only one and every round
reads it again.  A bucket sends its distinct window hashes, cut into hash
ranges, as packed binary rows: a hash that occurs any number of times in a
bucket travels once, so a hot passage costs one entry a bucket.  The task of a
hash range answers every bucket with one bit an entry (repeated or not), and the
bits return to the buckets for the next round, with those of the rounds before,
so each round is answered once.  Nothing goes through the driver; a lost task
recomputes from the shuffle files.

The first rounds only prune and compare 32 bits within a hash range (a false
match merely keeps a candidate); the last compares 128 bits and the order of
first occurrences.

Defined cases: null text has no words; texts under 20 words lose nothing; null
doc_id sorts after all others; rows sharing a doc_id are ordered by their
bucket and text; of identical rows one counts as earlier.  Extra columns pass
through, ``n_words``, ``n_removed`` and ``kept_sha256`` are replaced if they
exist.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mcqflow.llm import words as W

BUCKET = "__bucket"
_BLOB = "g int, b int, fp binary, hb binary, doc binary, old array<binary>"
_MASK = "b int, g int, masks array<binary>"
_LAST = np.int64(np.iinfo(np.int64).max)


def _ordered(t: pa.Table, id_col: str, text_col: str) -> pa.Table:
    order = pc.sort_indices(t.select([id_col, text_col]),
                            sort_keys=[(id_col, "ascending"), (text_col, "ascending")],
                            null_placement="at_end")
    return t.take(order)


def _cuts(keys: np.ndarray, n_groups: int) -> np.ndarray:
    """Borders of the hash ranges in sorted 64-bit keys."""
    g = ((keys >> np.uint64(32)) * np.uint64(n_groups)) >> np.uint64(32)
    return np.searchsorted(g, np.arange(n_groups + 1, dtype=np.uint64))


class _Level:
    """Distinct windows of one level of a bucket: positions, their distinct
    keys in sorted order and each position's key index."""

    def __init__(self, pos, key):
        self.pos = pos
        self.keys, self.inv, self.count = np.unique(key, return_inverse=True, return_counts=True)


def _masks(right: pa.Table, level: int, n: int, cuts: np.ndarray) -> np.ndarray:
    """The answered bits of a level, in the order of its sorted keys."""
    out = np.zeros(n, bool)
    for g, m in zip(right.column("g").to_pylist(), right.column("masks").to_pylist()):
        lo, hi = cuts[g], cuts[g + 1]
        if m[level]:
            out[lo:hi] = np.unpackbits(np.frombuffer(m[level], np.uint8), count=hi - lo).astype(bool)
    return out


def _survivors(h, first, lens, right, upto, n_groups):
    """Run the levels whose answers are known; returns the level to ask next."""
    key = np.zeros(len(h), np.uint64)
    w = W.windows(h, lens[0])
    key[:len(w)] = w
    alive = W.within(first, len(h), lens[0])
    for k, size in enumerate(lens):
        pos = np.flatnonzero(alive)
        lv = _Level(pos, key[pos])
        if k == upto:
            return lv, key
        rep = (lv.count > 1) | _masks(right, k, len(lv.keys), _cuts(lv.keys, n_groups))
        keep = np.zeros(len(h), bool)
        keep[pos] = rep[lv.inv]
        # both halves repeat and the window of double length stays in its document
        alive = np.zeros(len(h), bool)
        if len(h) > size:
            alive[:-size] = keep[:-size] & keep[size:]
        alive &= W.within(first, len(h), 2 * size)
        nxt = np.zeros(len(h), np.uint64)
        p = np.flatnonzero(alive)
        nxt[p] = W.join_pairs(key[p], key[p + size])
        key = nxt
    raise AssertionError("unreachable")


def _ask(level, lens, n_groups, id_col, text_col):
    """Bucket task: this level's distinct windows as one packed row a hash range."""
    last = level == len(lens) - 1

    def run(docs: pa.Table, right: pa.Table | None) -> pa.Table:
        bucket = docs.column(BUCKET)[0].as_py() if docs.num_rows else -1
        cols = {n: [] for n in ("g", "b", "fp", "hb", "doc", "old")}
        earlier = dict(zip(right.column("g").to_pylist(), right.column("masks").to_pylist())) if right is not None else {}
        if docs.num_rows:
            docs = _ordered(docs, id_col, text_col)
            buf, off = W.text_bytes(docs.column(text_col))
            _, _, h, first = W.scan(buf, off)
            lv, _ = _survivors(h, first, lens, right, level, n_groups)
            cuts = _cuts(lv.keys, n_groups)
            second, doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            if last and len(lv.keys):
                at = np.full(len(lv.keys), len(h), np.int64)
                np.minimum.at(at, lv.inv, lv.pos)
                ids = pc.fill_null(docs.column(id_col).cast(pa.int64()), int(_LAST)).to_numpy()
                doc = ids[np.searchsorted(first, at, "right") - 1].astype(np.int64)
                second = W.mix(_second(h, at, lens[-1]))
            for g in sorted({*np.flatnonzero(np.diff(cuts)).tolist(), *earlier}):
                lo, hi = cuts[g], cuts[g + 1]
                cols["old"].append(earlier.get(g, [None] * level))
                cols["g"].append(int(g))
                cols["b"].append(bucket)
                if last:
                    cols["fp"].append(lv.keys[lo:hi].tobytes())
                    cols["hb"].append(second[lo:hi].tobytes())
                    cols["doc"].append(doc[lo:hi].tobytes())
                else:
                    cols["fp"].append(lv.keys[lo:hi].astype(np.uint32).tobytes())
                    cols["hb"].append(None)
                    cols["doc"].append(None)
        return pa.table({"g": pa.array(cols["g"], pa.int32()), "b": pa.array(cols["b"], pa.int32()),
                         **{n: pa.array(cols[n], pa.binary()) for n in ("fp", "hb", "doc")},
                         "old": pa.array(cols["old"], pa.list_(pa.binary()))})

    if level == 0:
        return lambda docs: run(docs, None)
    return run


def _second(h, at, n):
    """A second hash of the windows, with another multiplier."""
    acc = np.zeros(len(at), np.uint64)
    for k in range(n):
        acc = acc * np.uint64(0x9FB21C651E98DF25) + (h[at + k] ^ np.uint64(0x5851F42D4C957F2D))
    return acc


def _answer(last):
    """Hash-range task: one bit an entry -- repeated elsewhere (or, at the last
    level, first met elsewhere)."""

    def run(t: pa.Table) -> pa.Table:
        b = t.column("b").to_pylist()
        blobs = t.column("fp").to_pylist()
        size = 8 if last else 4
        n = np.array([len(x) // size for x in blobs], np.int64)
        fp = np.frombuffer(b"".join(blobs), np.uint64 if last else np.uint32)
        del blobs
        if last:
            hb = np.frombuffer(b"".join(t.column("hb").to_pylist()), np.uint64)
            doc = np.frombuffer(b"".join(t.column("doc").to_pylist()), np.int64)
            own = np.repeat(np.array(b, np.int64), n)
            order = np.lexsort((own, doc, hb, fp))
            same = np.zeros(len(fp), bool)
            same[1:] = (fp[order][1:] == fp[order][:-1]) & (hb[order][1:] == hb[order][:-1])
            bit = np.zeros(len(fp), bool)
            bit[order] = same
        else:
            order = np.argsort(fp, kind="stable")
            s = fp[order]
            eq = s[1:] == s[:-1]
            same = np.zeros(len(fp), bool)
            same[1:] |= eq
            same[:-1] |= eq
            bit = np.zeros(len(fp), bool)
            bit[order] = same
        ends = np.cumsum(n)
        own = [bit[z - k:z] for z, k in zip(ends, n)]
        masks = [[*o, np.packbits(m).tobytes() if m.any() else None] for o, m in zip(t.column("old").to_pylist(), own)]
        keep = [i for i, m in enumerate(masks) if any(m)]  # no row: nothing repeats
        return pa.table({"b": pa.array([b[i] for i in keep], pa.int32()),
                         "g": pa.array([t.column("g")[i].as_py() for i in keep], pa.int32()),
                         "masks": pa.array([masks[i] for i in keep], pa.list_(pa.binary()))})
    return run


def kept_text(buf, off, starts, ends, first, keep):
    """Kept words of each row joined by one space: (bytes, offsets)."""
    n_rows = len(off) - 1
    delta = np.zeros(len(buf) + 2, np.int32)
    s, e = starts[keep], ends[keep]
    row = np.searchsorted(first, np.flatnonzero(keep), "right") - 1
    is_last = np.ones(len(s), bool)
    is_last[:-1] = row[:-1] != row[1:]
    sep = ~is_last  # a kept word before the last one is followed by white space
    np.add.at(delta, s, 1)
    np.add.at(delta, e + sep, -1)
    take = np.cumsum(delta[:len(buf)]) > 0
    out = buf.copy()
    out[e[sep]] = 0x20
    pos = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(take, out=pos[1:])
    return out[take], pos[off] if n_rows else np.zeros(1, np.int64)


def _finish(lens, n_groups, id_col, text_col, schema: pa.Schema):
    def run(docs: pa.Table, right: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        docs = _ordered(docs, id_col, text_col)
        valid = pc.is_valid(docs.column(text_col)).to_numpy()
        buf, off = W.text_bytes(docs.column(text_col))
        starts, ends, h, first = W.scan(buf, off)
        lv, _ = _survivors(h, first, lens, right, len(lens) - 1, n_groups)
        covered = np.zeros(len(h), bool)
        if len(lv.keys):
            later = _masks(right, len(lens) - 1, len(lv.keys), _cuts(lv.keys, n_groups))
            at = np.full(len(lv.keys), len(h), np.int64)
            np.minimum.at(at, lv.inv, lv.pos)
            gone = lv.pos[later[lv.inv] | (lv.pos != at[lv.inv])]
            d = np.zeros(len(h) + 1, np.int32)
            np.add.at(d, gone, 1)
            np.add.at(d, gone + lens[-1], -1)
            covered = np.cumsum(d[:-1]) > 0
        kept, koff = kept_text(buf, off, starts, ends, first, ~covered)
        c = np.zeros(len(h) + 1, np.int64)
        np.cumsum(covered, out=c[1:])
        view = memoryview(kept.tobytes())
        cols = {f.name: docs.column(f.name) for f in schema if f.name in docs.column_names}
        cols[text_col] = W.string_column(kept, koff, valid)
        cols["n_words"] = pa.array(np.diff(first), pa.int64())
        cols["n_removed"] = pa.array(np.diff(c[first]), pa.int64())
        cols["kept_sha256"] = pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(koff[:-1], koff[1:])], pa.string())
        return pa.table([cols[f.name] for f in schema], schema=schema)
    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     window: int = 20, levels: int = 3) -> DataFrame:
    """``docs`` with ``text`` replaced by its kept words (joined by one space;
    null stays null) and n_words, n_removed, kept_sha256 added.

    ``window`` must be divisible by 2 ** (levels - 1); the first level has
    window / 2 ** (levels - 1) words.
    """
    base, rest = divmod(window, 1 << (levels - 1))
    if rest or base < 1:
        raise ValueError("window must be a multiple of 2 ** (levels - 1)")
    lens = [base << k for k in range(levels)]
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets, n_groups = 3 * parts, max(1, parts // 2)
    docs = docs.drop("n_words", "n_removed", "kept_sha256", BUCKET)
    out_schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()),
                               T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    dealt = docs.withColumn(BUCKET, F.pmod(F.xxhash64(id_col, text_col), F.lit(n_buckets)).cast("int"))
    masks = None
    for k in range(levels):
        ask = _ask(k, lens, n_groups, id_col, text_col)
        if masks is None:
            blobs = dealt.groupBy(BUCKET).applyInArrow(ask, _BLOB)
        else:
            blobs = dealt.groupBy(BUCKET).cogroup(masks.groupBy("b")).applyInArrow(ask, _BLOB)
        masks = blobs.groupBy("g").applyInArrow(_answer(k == levels - 1), _MASK)
    from pyspark.sql.pandas.types import to_arrow_schema
    finish = _finish(lens, n_groups, id_col, text_col, to_arrow_schema(out_schema))
    return dealt.groupBy(BUCKET).cogroup(masks.groupBy("b")).applyInArrow(finish, out_schema)


def report(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", "kept_sha256")
