"""Benchmark decontamination by q-gram lemma filtering.

A benchmark item of m characters counts as leaked where a document holds a
passage within k = floor(EDIT_RATE * m) edits of it.  Each edit destroys at
most q of the item's m + 1 - q character q-grams, and at most k insertions or
deletions shift a match over at most k + 1 neighbouring diagonals.  So a match
shares at least m + 1 - q - k q q-grams with the document inside one of the
diagonal bands of width 2 (k + 1) laid at every (k + 1)-th diagonal.  Bands
that reach the bound are aligned within the band (edit distance, free ends in
the document); those within k edits are matches.  Items shorter than q
characters have no q-gram: their whole text is looked up and matches exactly.

Documents and items are compared in lower case with runs of white space (that
of ``str.split``) as one space; positions are characters of that form.  The whole text is scanned.

The benchmark is processed in blocks of bounded size (``BLOCK_CHARS``
characters expected): its size is counted first, and a block's index travels
with the tasks.  One block is one pass over the documents, nothing is shuffled.
For more blocks the documents are written once with a row number; each block is
a pass of its own that ends with its matches (row number, matches) written, so
one index lives at a time, and the matches are joined to the rows at the end.
Common q-grams are counted in parts of bounded size; a row and an item that have
more pairs of positions than one part (a long ruler, a table of zeros) are
counted band by band instead, with the same counts.

Defined cases: null and empty texts match nothing; items with null or blank
text are ignored; an item shorter than q characters matches wherever its text
stands, also inside a word; an item whose bound is not positive gets the largest edit
budget at which it is; equal items are reported each; repeated documents are
judged each; extra columns pass through, a column named matches is replaced.
"""

from __future__ import annotations

from bisect import bisect
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mcqflow.llm import words as W
from mcqflow.session import materialize

Q = 12
EDIT_RATE = 0.05
BLOCK_CHARS = 4_000_000
PAIRS = 1 << 19  # pairs of a text and an item position, or of a band and one, held at a time
CELLS = 1 << 20  # characters aligned at a time
MATCH = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType()), T.StructField("distance", T.IntegerType())]))
_A = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22
# white space of str.split that W._WS has not
_WIDE = "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def normalized(col):
    """(code points, row offsets) of texts in the compared form."""
    col = pc.replace_substring_regex(col.cast(pa.large_string()), _WIDE, " ")
    buf, off = W.text_bytes(pc.utf8_lower(col))
    if not len(buf):
        return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
    ws = W._WS[buf]
    keep = np.ones(len(buf), bool)
    keep[1:] = ~(ws[1:] & ws[:-1])
    edges = off[:-1][off[:-1] < len(buf)]
    keep[edges] = True
    out = np.where(ws, np.uint8(0x20), buf)[keep]
    lead = np.zeros(len(buf) + 1, np.int64)  # characters begun before each byte
    np.cumsum(keep & ((buf & 0xC0) != 0x80), out=lead[1:])
    return np.frombuffer(out.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), lead[off]


def _qgrams(c, q):
    """Hash of the q characters from each position (positions near the end are short)."""
    n = len(c) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, size, total, acc = c.astype(np.uint64) + np.uint64(1), 1, 0, None
    power = np.array([_A])
    while True:
        if q & size:
            part = h[total:total + n]
            acc = part if acc is None else acc * power + part
            total += size
        if size * 2 > q:
            break
        h = h[:-size] * power + h[size:]
        power = power * power
        size *= 2
    return W.mix(acc)


class Index:
    """q-grams of a block of items."""

    def __init__(self, item_ids, texts, q=Q, rate=EDIT_RATE):
        self.q = q
        c, off = normalized(pa.array(texts, pa.string()))
        ids, self.text, self.k, self.need = [], [], [], []
        short = {}  # by length: (item_id, text)
        for i, a, z in zip(item_ids, off[:-1], off[1:]):
            a, z = a + (a < z and c[a] == 0x20), z - (a + 1 < z and c[z - 1] == 0x20)
            m = int(z - a)
            k = int(rate * m)
            while k and m + 1 - q - k * q < 1:
                k -= 1
            if 0 < m < q:
                short.setdefault(m, []).append((i, c[a:z]))
            elif m:
                ids.append(i)
                self.text.append(c[a:z])
                self.k.append(k)
                self.need.append(m + 1 - q - k * q)
        self.short = []  # (length, sorted hashes, item numbers, their texts); numbers go on after the long items
        for m, own in sorted(short.items()):
            h = np.concatenate([_qgrams(t, m) for _, t in own])
            order = np.argsort(h, kind="stable")
            self.short.append((m, h[order], len(ids) + order, np.stack([own[x][1] for x in order])))
            ids.extend(i for i, _ in own)
        self.ids = ids
        self.m = np.array([len(t) for t in self.text], np.int64)
        self.k = np.array(self.k, np.int64)
        self.need = np.array(self.need, np.int64)
        grams = [_qgrams(t, q) for t in self.text]
        h = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        pos = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.item, self.pos = item[order], pos[order]
        self.keys, self.first, gram = np.unique(h[order], return_index=True, return_inverse=True)
        self.code = gram * len(self.m) + self.item  # ascending: a gram's entries are in order of items
        self.first = np.append(self.first, len(h))
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[self.keys >> np.uint64(64 - _BITS)] = True

    def regions(self, c, off):
        """Bands of a slab that meet the bound: (row, item, first diagonal)."""
        h = _qgrams(c, self.q)
        at = np.flatnonzero(self.seen[h >> np.uint64(64 - _BITS)])
        p = np.searchsorted(self.keys, h[at])
        p[p == len(self.keys)] = 0
        ok = self.keys[p] == h[at] if len(self.keys) else np.zeros(len(at), bool)
        at, p = at[ok], p[ok]
        row = np.searchsorted(off, at, "right") - 1
        inside = at + self.q <= off[row + 1]
        at, p, row = at[inside], p[inside], row[inside]
        found = [np.stack(f) for f in self._split(at - off[row], row, p, self.first[p], self.first[p + 1])]
        return tuple(np.concatenate(found, axis=1)) if found else (np.zeros(0, np.int64),) * 3

    def _split(self, local, row, p, lo, hi):
        """Bands of hits (``local``: place in the row, ``p``: gram, index entries lo to hi):
        parts with at most PAIRS pairs of a text and an item position are counted pair by
        pair, by rows, then by items; what one row and one item have above that, by bands."""
        some = hi > lo
        local, row, p, lo, hi = local[some], row[some], p[some], lo[some], hi[some]
        if not len(local):
            return
        total = np.cumsum(hi - lo)
        if total[-1] <= PAIRS:
            yield self._by_pairs(local, row, lo, hi)
            return
        if row[0] != row[-1]:
            cut = np.searchsorted(row, row[np.searchsorted(total, total[-1] // 2)], "left")
            if not cut:
                cut = np.searchsorted(row, row[0], "right")
            for x in (slice(None, cut), slice(cut, None)):
                yield from self._split(local[x], row[x], p[x], lo[x], hi[x])
            return
        first, last = int(self.item[lo].min()), int(self.item[hi - 1].max())
        if first == last:
            yield self._by_bands(local, int(row[0]), p, first)
            return
        mid = np.clip(np.searchsorted(self.code, p * len(self.m) + (first + last + 1) // 2), lo, hi)
        yield from self._split(local, row, p, lo, mid)
        yield from self._split(local, row, p, mid, hi)

    def _by_bands(self, local, row, p, item):
        """For each band of one row and one item: the item positions whose gram the row has in
        the band.  Work and memory go by bands times positions, not by pairs of positions."""
        own = np.flatnonzero(self.item == item)
        pos, key = self.pos[own], np.searchsorted(self.first, own, "right") - 1
        w, span = int(self.k[item]) + 1, int(local.max()) + 2
        text = np.sort(p * span + local)
        bands = np.arange((int(local.min()) - int(pos.max())) // w - 1, int(local.max()) // w + 1)
        good = []
        step = max(1, PAIRS // len(pos))
        for b in range(0, len(bands), step):
            begin = pos[None, :] + bands[b:b + step, None] * w
            lo, hi = (np.searchsorted(text, key * span + np.clip(x, 0, span - 1)) for x in (begin, begin + 2 * w))
            good.append(bands[b:b + step][(hi > lo).sum(1) >= self.need[item]])
        good = np.concatenate(good)
        return np.full(len(good), row), np.full(len(good), item), good * w

    def _by_pairs(self, local, row, lo, hi):
        n = hi - lo
        idx = W.gather(np.arange(len(self.item)), lo, n)
        local, row = np.repeat(local, n), np.repeat(row, n)
        item, pos = self.item[idx], self.pos[idx]
        w = self.k[item] + 1
        band = np.floor_divide(local - pos, w)
        row, item, pos, w = (np.concatenate((x, x)) for x in (row, item, pos, w))
        band = np.concatenate((band, band - 1))
        # distinct item positions in each (row, item, band)
        order = np.lexsort((pos, band, item, row))
        row, item, band, pos, w = row[order], item[order], band[order], pos[order], w[order]
        head = np.ones(len(row), bool)
        head[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        fresh = head.copy()
        fresh[1:] |= pos[1:] != pos[:-1]
        lead = np.flatnonzero(head)
        count = np.add.reduceat(fresh.astype(np.int64), lead)
        good = lead[count >= self.need[item[lead]]]
        return row[good], item[good], band[good] * w[good]

    def exact(self, c, off):
        """Places of the short items in a slab, without overlaps of one item: (row, item, start, end)."""
        for m, keys, item, text in self.short:
            h = _qgrams(c, m)
            lo = np.searchsorted(keys, h)
            at = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == h)
            row = np.searchsorted(off, at, "right") - 1
            inside = at + m <= off[row + 1]
            at, row = at[inside], row[inside]
            n = np.searchsorted(keys, h[at], "right") - lo[at]
            x = W.gather(np.arange(len(keys)), lo[at], n)
            at, row = np.repeat(at, n), np.repeat(row, n)
            same = np.ones(len(at), bool)
            for j in range(m):
                same &= c[at + j] == text[x, j]
            free = {}
            for r, y, s in zip(row[same].tolist(), item[x[same]].tolist(), (at - off[row])[same].tolist()):
                if s >= free.get((r, y), 0):
                    free[r, y] = s + m
                    yield r, y, s, s + m

    def align(self, c, off, row, item, diag):
        """Banded alignment of the regions: (distance, start, end) in the row."""
        k = self.k[item]
        base = diag - k  # first diagonal of the band
        width = int((4 * k + 2).max())
        m = self.m[item]
        top = int(m.max())
        n = len(row)
        j = off[row][:, None] + base[:, None] + np.arange(top + width)[None, :]
        inside = (j >= off[row][:, None]) & (j < off[row + 1][:, None])
        text = np.where(inside, c[np.clip(j, 0, len(c) - 1)], np.uint32(0xFFFFFFFF))
        pat = np.full((n, top), 0xFFFFFFFE, np.uint32)
        for r in range(n):
            pat[r, :m[r]] = self.text[item[r]]
        d = np.zeros((n, width), np.int32)
        org = np.tile(np.arange(width, dtype=np.int32), (n, 1))
        step = np.arange(width, dtype=np.int32)
        best, at, begun = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i in range(1, top + 1):
            sub = d + (text[:, i - 1:i - 1 + width] != pat[:, i - 1:i])
            gone = np.full_like(d, 1 << 20)
            gone[:, :-1] = d[:, 1:] + 1
            take = gone < sub
            t = np.where(take, gone, sub) - step
            o = org.copy()
            o[:, :-1] = np.where(take[:, :-1], org[:, 1:], org[:, :-1])
            run = np.minimum.accumulate(t, axis=1)
            src = np.maximum.accumulate(np.where(t == run, step, 0), axis=1)
            d = run + step
            org = np.take_along_axis(o, src, axis=1)
            done = np.flatnonzero(m == i)
            if len(done):
                e = d[done].argmin(1)
                best[done] = d[done, e]
                at[done] = base[done] + e + i
                begun[done] = base[done] + org[done, e]
        return best, begun, at


def _search(index, col):
    """Matches of every row of a text column: lists of (item_id, start, end, distance)."""
    out = [[] for _ in range(len(col))]
    short = [[] for _ in range(len(col))]
    if not len(index.ids) or not len(col):
        return out
    raw_off = W.text_bytes(col)[1]
    for lo, hi in W.slabs(raw_off):
        c, off = normalized(col.slice(lo, hi - lo))
        for x, *found in index.exact(c, off):
            short[lo + x].append((*found, 0))
        row, item, diag = index.regions(c, off)
        order = np.argsort(-index.m[item], kind="stable")  # like lengths together, the longest first
        row, item, diag = row[order], item[order], diag[order]
        z = 0
        while z < len(row):
            a, z = z, z + max(1, min(256, CELLS // int(index.m[item[z]] + 4 * index.k[item[z]] + 2)))
            r, it, dg = row[a:z], item[a:z], diag[a:z]
            dist, begun, end = index.align(c, off, r, it, dg)
            for x, y, s, e, v in zip(r, it, begun, end, dist):
                if v <= index.k[y]:
                    out[lo + x].append((int(y), int(max(0, s)), int(e), int(v)))
    for r, found in enumerate(out):
        if not found and not short[r]:
            continue
        kept, taken = [], {}  # neighbouring bands find the same passage: the closest one stays
        for y, s, e, v in sorted(set(found), key=lambda f: (f[0], f[3], f[1], f[2])):
            own = taken.setdefault(y, [])  # disjoint passages of the item, in order
            at = bisect(own, (s, e))
            if not (at and own[at - 1][1] > s) and not (at < len(own) and own[at][0] < e):
                own.insert(at, (s, e))
                kept.append((y, s, e, v))
        out[r] = sorted((index.ids[y], s, e, v) for y, s, e, v in kept + short[r])
    return out


def _structs(found):
    return [{"item_id": i, "start": s, "end": e, "distance": v} for i, s, e, v in found]


def _task(index, text_col, schema):
    def run(batches):
        for b in batches:
            made = pa.array([_structs(f) for f in _search(index, b.column(text_col))], schema.field("matches").type)
            yield pa.RecordBatch.from_arrays([made if f.name == "matches" else b.column(f.name).cast(f.type) for f in schema], schema=schema)
    return run


def _block_task(index, schema):
    """Only the rows with a match: (__at, matches)."""
    def run(batches):
        for b in batches:
            found = _search(index, b.column("__text"))
            hit = [r for r, f in enumerate(found) if f]
            yield pa.RecordBatch.from_arrays([b.column("__at").take(pa.array(hit, pa.int64())),
                                              pa.array([_structs(found[r]) for r in hit], schema.field("matches").type)], schema=schema)
    return run


def find_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", q: int = Q, rate: float = EDIT_RATE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` plus ``matches``: array of (item_id, start, end, distance)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    docs = docs.drop("matches")

    def block(k):  # about block_chars characters
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        own.sort(key=lambda r: (r.item_id is None, r.item_id, r.text))
        return Index([r.item_id for r in own], [r.text for r in own], q, rate)

    if blocks == 1:
        schema = T.StructType([*docs.schema.fields, T.StructField("matches", MATCH)])
        return docs.mapInArrow(_task(block(0), text_col, to_arrow_schema(schema)), schema)
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("__at"), F.struct(*docs.columns).alias("__doc")), "leak-rows")
    texts = rows.select("__at", F.col("__doc")[text_col].alias("__text"))
    schema = T.StructType([T.StructField("__at", T.LongType()), T.StructField("matches", MATCH)])
    parts = [materialize(texts.mapInArrow(_block_task(block(k), to_arrow_schema(schema)), schema), "leaks")
             for k in range(blocks)]
    leaks = (reduce(DataFrame.unionAll, parts).groupBy("__at")
             .agg(F.array_sort(F.flatten(F.collect_list("matches"))).alias("matches")))
    return rows.join(leaks, "__at", "left").select("__doc.*", F.coalesce("matches", F.array().cast(MATCH)).alias("matches"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The documents without a match, with their own columns."""
    return find_matches(docs, benchmark, **kw).where(F.size("matches") == 0).drop("matches")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row a match."""
    return (find_matches(docs.select("doc_id", "text"), benchmark).select("doc_id", F.explode("matches").alias("m"))
            .select("doc_id", "m.item_id", "m.start", "m.end", "m.distance"))
