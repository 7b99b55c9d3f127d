"""Periodic run detection by the dictionary of basic factors.

A run is a stretch of consecutive words of one text with smallest period q and
at least ``max(MIN_WORDS, MIN_POWER * q)`` words that no neighbouring word
extends.  The basic factors of a text are its stretches of 2^k words; each has
a name, equal where the words are equal.

1. Names of level 0 are those of the words; a name of level k + 1 is the name
   of the pair of names at i and i + 2^k.  Factors that occur once in their
   text can start no repeated longer factor, so their positions drop out.
2. At level k the successor of a position is the next position with its name.
   Occurrences inside a window of twice the factor's length form an arithmetic
   progression, so successors at distance d <= 2^k propose d as a period.
3. Positions i0..i1 in a row that propose the same d are one progression of
   every factor of the stretch; it extends to the words i0..i1 + d + 2^k - 1.
   Its ends are those of the run: at i0 - 1 and at i1 + 1 the factors at
   distance d differ, or a nearer one is equal, which a run of 4 q words with
   period d excludes at 2^(k-1) < d <= 2^k.
4. Smaller d were proposed at a lower level already, so a level takes the
   d > 2^(k-1) only, and no run is found twice.

A smaller period than the proposed one cannot be: with 3 d words it would
divide d and be a nearer successor.

Texts are dealt with in their own partitions, nothing is shuffled.  A task
holds a slab of whole texts of about ``W.SLAB_BYTES`` bytes, or one longer text.

Defined cases: null and blank texts have no words, no runs, and stay as they
are; a null doc_id changes nothing; equal rows are each judged; columns named
runs, n_words or collapsed are replaced, others pass through; an empty table
gives no rows.  Words are told apart by 64-bit hashes within a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mcqflow.llm import words as W

MIN_WORDS, MIN_POWER = 6, 4
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
_MADE = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]


def _named(*keys: np.ndarray) -> np.ndarray:
    """Dense names of the rows of some integer columns; -1 where a row occurs once."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    number = np.cumsum(new) - 1
    lone = np.bincount(number) == 1
    out = np.empty(len(order), np.int64)
    out[order] = np.where(lone[number], -1, number)
    return out


def runs_of(h: np.ndarray, first: np.ndarray, least: int = MIN_WORDS, power: int = MIN_POWER):
    """Runs of rows of words (hashes ``h``, row r in ``first[r]:first[r + 1]``):
    (row, start in the row, length, period), by row, start, period."""
    n = len(h)
    found = [np.zeros((0, 3), np.int64)]
    if n:
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        name = _named(h, row)  # names are of one row, so equal names never pair two rows
        longest, k = int(np.diff(first).max()), 0
        while True:
            size = 1 << k
            at = np.flatnonzero(name >= 0)
            if not len(at) or size // 2 * power >= longest:
                break
            by_name = at[np.argsort(name[at], kind="stable")]
            dist = np.zeros(n + 1, np.int64)
            same = name[by_name[1:]] == name[by_name[:-1]]
            dist[by_name[:-1][same]] = np.diff(by_name)[same]
            dist[(dist > size) | (2 * dist <= size)] = 0
            edge = np.flatnonzero(np.concatenate(([True], dist[1:] != dist[:-1])))
            begin, stop = edge[:-1], edge[1:]  # stretches of one distance; the last has distance 0
            d = dist[begin]
            length = stop - begin - 1 + d + size
            ok = (d > 0) & (length >= np.maximum(least, power * d))
            found.append(np.stack([begin[ok], length[ok], d[ok]], 1))
            pair = at[at + size < n]
            pair = pair[name[pair + size] >= 0]
            pair = pair[row[pair] == row[np.minimum(pair + 2 * size - 1, n - 1)]]
            pair = pair[pair + 2 * size <= n]
            longer = np.full(n, -1, np.int64)
            longer[pair] = _named(name[pair], name[pair + size])
            name, k = longer, k + 1
    out = np.concatenate(found)
    out = out[np.lexsort((out[:, 2], out[:, 0]))]
    r = np.searchsorted(first, out[:, 0], "right") - 1
    return r, out[:, 0] - first[r], out[:, 1], out[:, 2]


def _joined(buf, starts, ends, keep, first):
    """The kept words of each row joined by one space: (bytes, offsets)."""
    s, length = starts[keep], ends[keep] - starts[keep]
    before = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    words = before[first]  # kept words before each row
    padded = np.append(buf, np.uint8(0x20))
    total = int(length.sum()) + len(length)
    at = np.cumsum(length + 1)
    idx = np.arange(total) + np.repeat(s - (at - length - 1), length + 1)
    idx[at - 1] = len(buf)  # the space after a word
    flat = padded[idx]
    offs = np.concatenate(([0], at))[words]
    full = np.diff(offs) > 0
    drop = np.ones(total, bool)
    drop[offs[1:][full] - 1] = False  # no space after the last word of a row
    return flat[drop], offs - np.concatenate(([0], np.cumsum(full)))


def _task(text_col, schema, least, power):
    kind = schema.field("runs").type

    def run(batches):
        for b in batches:
            whole, cuts = W.text_bytes(b.column(text_col))
            for lo, hi in W.slabs(cuts):
                part = b.slice(lo, hi - lo)
                off = cuts[lo:hi + 1] - cuts[lo]
                buf = whole[cuts[lo]:cuts[hi]]
                starts, ends, h, first = W.scan(buf, off)
                row, start, length, period = runs_of(h, first, least, power)
                gone = np.zeros(len(h) + 1, np.int64)
                np.add.at(gone, first[row] + start + period, 1)
                np.add.at(gone, first[row] + start + length, -1)
                kept, koff = _joined(buf, starts, ends, np.cumsum(gone[:-1]) == 0, first)
                valid = part.column(text_col).is_valid().to_numpy(zero_copy_only=False)
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(hi - lo + 1)), pa.int32()),
                                                 pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], names=["start", "length", "period"]))
                made = {"n_words": pa.array(np.diff(first), pa.int64()), "runs": lists.cast(kind), "collapsed": W.string_column(kept, koff, valid)}
                yield pa.RecordBatch.from_arrays([(made[f.name] if f.name in made else part.column(f.name)).cast(f.type) for f in schema], schema=schema)
    return run


def find_runs(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS, min_power: int = MIN_POWER) -> DataFrame:
    """``docs`` plus ``n_words``, ``runs`` (start, length, period by start, then
    period; word numbers from 0) and ``collapsed`` (the text's words without
    those that a run holds after its first period, joined by one space)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    if min_power < MIN_POWER:
        raise ValueError(f"runs of less than {MIN_POWER} periods are not all found")
    docs = docs.drop(*[f.name for f in _MADE])
    schema = T.StructType([*docs.schema.fields, *_MADE])
    return docs.mapInArrow(_task(text_col, to_arrow_schema(schema), min_words, min_power), schema)


def collapse_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each run shortened to its first period; texts without a run stay as they are."""
    columns = docs.columns
    made = find_runs(docs.select(F.struct(*columns).alias("__row"), F.col(text_col).alias("__text")), "__text")
    text = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("__text"))
    return made.select(*[(text if c == text_col else F.col(f"__row.`{c}`")).alias(c) for c in columns])


def planted(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text of the query's contract: in each tenth document the words from a
    place on repeat with a period, both given by the hash of its id."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g = F.floor(h / 10)

    def periodic(w: Column) -> Column:  # w: a variable of the outer transform, so the words are cut once
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                                        lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")
    text = F.col(text_col)
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), F.get(F.transform(F.array(words), periodic), 0)).otherwise(text)


def report(docs: DataFrame) -> DataFrame:
    """One row a document: the runs of its planted text, the one of greatest exponent, two digests."""
    made = find_runs(docs.select("doc_id", planted().alias("text")))
    # exponents compared exactly: length / period = whole + rest / period, and as doubles two
    # different rests below 2^26 differ by more than their rounding
    rank = F.transform("runs", lambda r: F.struct(
        (-F.floor(r["length"] / r["period"])).alias("a"), (-(r["length"] % r["period"]) / r["period"]).alias("b"),
        r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    best = F.array_min(rank)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return made.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"), "n_words")
