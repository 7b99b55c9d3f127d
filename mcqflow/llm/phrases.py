"""Phrase collocation mining by top-order marginalisation.

Phrases of 2 to ``n`` words that occur ``min_count`` times or more in one
language, scored by their weakest cut a * a / (left * right), without those
that a longer phrase mostly contains.

1. A text is cut at ``.,;:!?`` and line ends into pieces and these at blanks
   and tabs into words.  Every word starts one window of ``n`` words; where its
   piece ends, the window is padded.  These windows, lead columns of the word
   itself, are the only thing counted.
2. The counts of windows (lang, w1..wn) are summed by ROLLUP (lang, w1..wn-1):
   a phrase's occurrences are the windows that start with it, so every shorter
   prefix is a sum of longer ones, and the language's sum is its words.  Equal
   windows of a slab are combined before anything is shuffled, so a hot window
   costs a row a slab.  The one large shuffle deals windows by their words but
   the last, so the sums over the last word are complete before the ROLLUP, and
   prefixes below ``min_count`` are folded into shorter ones there.
3. Phrases below ``min_count`` are dropped; what is left is small, and is joined
   with itself: a candidate of m words meets its parts (both are as frequent as
   it, so they are there too) and the candidates of m + 1 words around it.  Only
   these matter: a longer phrase that holds a candidate at least half of the
   time contains one of m + 1 words that does.
4. The first ``top`` rows of a language are taken within each task, then of all.

Words travel as 64-bit hashes, and ``vocabulary`` gives the words back.  It is
counted first; if two words of it share a hash, another salt is taken.  A fixed
bitmap of ``MARK_BITS`` bits marks the words with ``min_count`` or more
occurrences (a word more may be marked, none is missed): an unmarked word is in
no candidate, so it ends the windows it is in like a piece's end does, and
starts one that only the language's sum counts.

Scores are whole numbers: products are decimals of 38 digits, enough for counts
up to 10^15.

Defined cases: null and blank texts have no words; a null language counts as
``und``, together with texts whose language is that; repeated rows count each;
an empty table gives no rows; only the language and the text are read, so other
columns cannot clash; very long texts are one slab.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mcqflow.llm import words as W
from mcqflow.session import materialize

MIN_COUNT, TOP, COVER_PCT, SCALE = 10, 2000, 50, 1_000_000
MARK_BITS = 26
SLAB = 4 << 20  # windows of texts of about this size are combined at once
PAD = 0
_MAX_SALTS = 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0 part of a word, 1 blank, 2 end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2


def _salted(salt: int) -> np.ndarray:
    return np.arange(256, dtype=np.uint8) if not salt else np.random.RandomState(salt).permutation(256).astype(np.uint8)


def scan(buf: np.ndarray, off: np.ndarray, salt: int = 0):
    """Lower-cased bytes, and the words: starts, ends, hashes, piece numbers (by text and place)."""
    low = _LOWER[buf]
    if not len(low):
        none = np.zeros(0, np.int64)
        return low, none, none, none.astype(np.uint64), none
    kind = _KIND[low]
    ink = kind == 0
    edge = np.zeros(len(low) + 1, bool)
    edge[off] = True  # texts end words
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1] | edge[1:-1]
    last[:-1] &= ~ink[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    cut = np.cumsum(kind == 2)
    text = np.searchsorted(off, starts, "right")
    h = W.span_hashes(_salted(salt)[low], starts, ends)
    h[h == PAD] = 1
    return low, starts, ends, h, cut[starts] + text  # both grow with the place


def _slabs(b, limit):
    """(language numbers, language names, bytes, offsets) of slabs of whole texts."""
    lang = b.column("lang").dictionary_encode()
    code, names = lang.indices.to_numpy(zero_copy_only=False), lang.dictionary
    buf, off = W.text_bytes(b.column("text"))
    for lo, hi in W.slabs(off, limit):
        yield code[lo:hi], names, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]


def _counted(keys: list[np.ndarray]):
    """Distinct rows of key columns, sorted: (index of one of each, how many)."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


def _vocabulary_task(salt):
    def run(batches):
        for b in batches:
            for code, names, buf, off in _slabs(b, 2 << 20):
                low, s, e, h, _ = scan(buf, off, salt)
                lang = code[np.searchsorted(off, s, "right") - 1]
                one, n = _counted([lang, h])
                length = e[one] - s[one]
                word = W.string_column(W.gather(low, s[one], length), np.concatenate(([0], np.cumsum(length))))
                yield pa.RecordBatch.from_pydict({"lang": names.take(pa.array(lang[one], pa.int32())).cast(pa.string()), "word": word,
                                                  "h": pa.array(h[one].view(np.int64)), "n": pa.array(n, pa.int64())})
    return run


def vocabulary(texts: DataFrame) -> tuple[DataFrame, int]:
    """Words of each language (lang, word, h, n), written once, and the salt at
    which no two of a language share a hash."""
    for salt in range(_MAX_SALTS):
        words = texts.mapInArrow(_vocabulary_task(salt), "lang string, word string, h long, n long")
        words = materialize(words.groupBy("lang", "word", "h").agg(F.sum("n").alias("n")), "phrase-words")
        if not words.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").head(1):
            return words, salt
    raise RuntimeError("words share hashes at every salt")


def _place(h: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Bit of a word of a language in the bitmap (``lang``: crc32 of its name)."""
    return (W.mix(h ^ (lang << np.uint64(16))) >> np.uint64(64 - MARK_BITS)).astype(np.int64)


def _place_task(batches):
    for b in batches:
        at = _place(b.column("h").to_numpy().view(np.uint64), b.column("c").to_numpy().astype(np.uint64))
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64())})


def marks(frequent: DataFrame) -> bytes:
    """The bitmap of some words (lang, h): 2^MARK_BITS bits, whatever their number."""
    at = frequent.select("h", F.crc32(F.col("lang").cast("binary")).alias("c")).mapInArrow(_place_task, "at long")
    # Spark's bitmap functions count places from 1 and hold 32,768 bits a row
    rows = (at.groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bits")).collect())
    out = bytearray(1 << (MARK_BITS - 3))
    for r in rows:  # at most 2^(MARK_BITS - 15) rows of 4,096 bytes
        out[(r.b - 1) * 4096:r.b * 4096] = r.bits
    return bytes(out)


def _window_task(n, salt, bitmap):
    def run(batches):
        from zlib import crc32
        bits = np.frombuffer(bitmap.value, np.uint8)
        for b in batches:
            for code, names, buf, off in _slabs(b, SLAB):
                parts = []
                crc = np.array([crc32(x.encode()) for x in names.to_pylist()], np.uint64)
                for lo, hi in W.slabs(off, 1 << 20):
                    _, s, _, h, piece = scan(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], salt)
                    lang = code[lo + np.searchsorted(off[lo:hi + 1] - off[lo], s, "right") - 1]
                    at = _place(h, crc[lang]) if len(h) else np.zeros(0, np.int64)
                    known = bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
                    cols = [np.where(known, h, PAD)]
                    for k in range(1, n):
                        lead = np.full(len(h), PAD, np.uint64)
                        ok = piece[k:] == piece[:-k] if len(h) > k else np.zeros(0, bool)
                        lead[:len(ok)][ok] = cols[0][k:][ok]
                        cols.append(np.where(cols[-1] == PAD, np.uint64(PAD), lead))
                    parts.append((lang, *cols))
                lang, *cols = (np.concatenate(x) for x in zip(*parts))
                one, count = _counted([lang, *cols])
                yield pa.RecordBatch.from_pydict({"lang": names.take(pa.array(lang[one], pa.int32())).cast(pa.string()),
                                                  **{f"w{k + 1}": pa.array(c[one].view(np.int64)) for k, c in enumerate(cols)},
                                                  "c": pa.array(count, pa.int64())})
    return run


def phrase_counts(texts: DataFrame, words: DataFrame, salt: int, n: int = 3, min_count: int = MIN_COUNT) -> DataFrame:
    """Phrases of 1 to ``n`` words with ``min_count`` occurrences or more: lang,
    w1..wn (hashes, PAD after the last), size, f; and size 0 for a language's words."""
    spark = texts.sparkSession
    bitmap = spark.sparkContext.broadcast(marks(words.where(F.col("n") >= min_count)))
    w = [f"w{k + 1}" for k in range(n)]
    windows = texts.mapInArrow(_window_task(n, salt, bitmap), f"lang string, {', '.join(x + ' long' for x in w)}, c long")
    # dealt by all words but the last: both sums below are complete where they stand
    windows = windows.repartition("lang", *w[:-1])
    full = windows.groupBy("lang", *w).agg(F.sum("c").alias("f"))
    pad = F.lit(PAD).cast("long")
    # one condition on the sum, which no rule moves below the aggregation: both branches then read one shuffle
    whole = F.when(F.col(w[-1]) == pad, 0).otherwise(F.col("f")) >= min_count
    longest = full.where(whole).select("lang", *w, F.lit(n).alias("size"), "f")
    # the last word is named (it is never null) so that this branch, too, reads the same columns of that shuffle
    lead = windows.groupBy("lang", *w[:-1]).agg(F.sum(F.when(F.col(w[-1]).isNotNull(), F.col("c"))).alias("f"))
    if n > 2:  # a rare one is no candidate: its last word ends it, as padding does, and few distinct rows are left
        lead = (lead.withColumn(w[-2], F.when(F.col("f") >= min_count, F.col(w[-2])).otherwise(pad))
                .groupBy("lang", *w[:-1]).agg(F.sum("f").alias("f")))
    # grouping_id counts the columns summed away; a prefix that ends in padding is a shorter phrase's
    up = lead.rollup("lang", *w[:-1]).agg(F.sum("f").alias("f"), F.grouping_id().alias("g"))
    size = n - 1 - F.length(F.regexp_replace(F.conv(F.col("g").cast("string"), 10, 2), "0", ""))
    shorter = (up.withColumn("size", size).where("size >= 0 and lang is not null")
               .where((F.col("size") == 0) | (F.col("f") >= min_count))
               .select("lang", *[F.coalesce(x, pad).alias(x) for x in w[:-1]], pad.alias(w[-1]), "size", "f"))
    last = F.lit(True)
    for k in range(1, n):
        last = last & ((F.col("size") != k) | (F.col(w[k - 1]) != pad))
    return materialize(longest.unionByName(shorter.where(last)), "phrase-counts")


def _words(w, lo, size, n, prefix) -> list[Column]:
    """Columns prefix1..prefixn: words lo.. of a phrase, padded."""
    return [(F.col(w[lo + k]) if k < size else F.lit(PAD).cast("long")).alias(f"{prefix}{k + 1}") for k in range(n)]


def collocations(docs: DataFrame, n: int = 3, min_count: int = MIN_COUNT, cover_pct: int = COVER_PCT, top: int = TOP,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a (its
    occurrences), l and r (those of the two parts of its weakest cut), n (words
    of the language), score."""
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).where("text is not null")
    words, salt = vocabulary(texts)
    f = phrase_counts(texts, words, salt, n, min_count)
    w = [f"w{k + 1}" for k in range(n)]
    key = ["lang", "size", *w]
    scored = None
    for m in range(2, n + 1):
        own = f.where(F.col("size") == m).withColumnRenamed("f", "a")
        cuts = None
        for k in range(1, m):
            sides = []
            for name, lo, size in (("l", 0, k), ("r", k, m - k)):
                part = f.where(F.col("size") == size).select("lang", *[F.col(w[j]).alias(f"{name}{j + 1}") for j in range(size)], F.col("f").alias(name))
                sides.append((part, [F.col(f"{name}{j + 1}") == F.col(f"o.{w[lo + j]}") for j in range(size)]))
            x = own.alias("o")
            for (part, on), name in zip(sides, "lr"):
                part = part.withColumnRenamed("lang", f"{name}lang")
                x = x.join(part, [F.col(f"{name}lang") == F.col("o.lang"), *on])
            dec = lambda c, p: F.col(c).cast(f"decimal({p},0)")
            top_ = dec("a", 15) * dec("a", 15) * F.lit(SCALE).cast("decimal(7,0)")
            x = x.select("o.*", F.col("l"), F.col("r"), F.lit(k).alias("k"), top_.alias("__x"), (dec("l", 15) * dec("r", 15)).alias("__y"))
            x = x.withColumn("score", F.expr("__x div __y")).drop("__x", "__y")
            cuts = x if cuts is None else cuts.unionByName(x)
        least = cuts.groupBy(*key, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
        scored = least if scored is None else scored.unionByName(least)
    scored = scored.select(*key, "a", "c.l", "c.r", "c.score")
    around = None  # for each phrase of m words, the most frequent one of m + 1 words that holds it
    for m in range(3, n + 1):
        long_ = f.where(F.col("size") == m)
        for lo in (0, 1):
            part = long_.select("lang", F.lit(m - 1).alias("size"), *_words(w, lo, m - 1, n, "w"), F.col("f").alias("longer"))
            around = part if around is None else around.unionByName(part)
    if around is not None:
        scored = (scored.join(around.groupBy(*key).agg(F.max("longer").alias("longer")), key, "left")
                  .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * cover_pct)))
    # words back, a position at a time: candidates and frequent words only
    known = words.where(F.col("n") >= min_count).select("lang", "h", "word")
    for k in range(n):
        scored = scored.join(known.select("lang", F.col("h").alias(w[k]), F.col("word").alias(f"s{k + 1}")), ["lang", w[k]], "left")
    total = f.where(F.col("size") == 0).select("lang", F.col("f").alias("n"))
    named = (scored.withColumn("phrase", F.concat_ws(" ", *[f"s{k + 1}" for k in range(n)])).join(total, "lang"))
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (named.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")))


def report(docs: DataFrame) -> DataFrame:
    return collocations(docs.select("lang", "text"))
