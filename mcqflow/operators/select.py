"""Exact quantiles by radix selection.

A (value, count) histogram is written once.  Each pass counts the values of the
ranges still in question by their next 16 bits, and the running count says in
which part a wanted rank lies; the last pass leaves the value itself.  A group's
range of parts has at most 65,536 rows in any pass, however many distinct values
there are, so no task holds a whole group.  The number of passes follows from the
spread of the values: one for lengths below 65,536, two below 2^32, four at most.

Defined cases: NULL values do not count; a group without values has a NULL
result; NULL group keys are a group; without groups there is one row, also for
an empty table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mcqflow.session import materialize

BITS = 16


def passes(lo: int | None, hi: int | None, bits: int = BITS) -> int:
    """Least number of passes at which the first has at most 2^bits parts."""
    n = 1
    while lo is not None and (hi >> bits * (n - 1)) - (lo >> bits * (n - 1)) >= 1 << bits:
        n += 1
    return n


def _same(a: DataFrame, b: DataFrame, names: dict[str, str]):
    cond = F.lit(True)
    for x, y in names.items():
        cond = cond & a[x].eqNullSafe(b[y])
    return cond


def rank_values(hist: DataFrame, targets: DataFrame, col: str, count: str, by: Sequence[str], n_passes: int,
                bits: int = BITS) -> DataFrame:
    """``targets`` (``by``, ``_r``: 0-based rank among the group's values) with ``value``.
    ``hist`` has one or more rows a (``by``, ``col``), without NULL values."""
    by = list(by)
    renamed = {b: f"_h{i}" for i, b in enumerate(by)}
    h = hist.select(*[F.col(b).alias(x) for b, x in renamed.items()], F.col(col).cast("bigint").alias("_v"), F.col(count).alias("_c"))
    t = targets.withColumn("_at", F.lit(0).cast("bigint"))
    for k in range(n_passes):
        parent = F.lit(0).cast("bigint") if k == 0 else F.shiftright("_v", bits * (n_passes - k))
        x = h.withColumn("_parent", parent)
        keys = renamed | {"_at": "_parent"}
        if k:  # ranges that hold a wanted rank; two rows a percentile and group, written since both joins read them
            t = materialize(t, "ranks")
            wanted = t.select(*by, "_at").distinct()
            x = x.join(wanted, _same(wanted, x, keys), "left_semi")
        x = x.groupBy(*renamed.values(), "_parent", F.shiftright("_v", bits * (n_passes - k - 1)).alias("_part")).agg(F.sum("_c").alias("_c"))
        w = Window.partitionBy(*renamed.values(), "_parent").orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        x = x.withColumn("_hi", F.sum("_c").over(w)).withColumn("_lo", F.col("_hi") - F.col("_c"))
        t = (t.join(x, _same(t, x, keys) & (t["_r"] >= x["_lo"]) & (t["_r"] < x["_hi"]))
             .withColumn("_r", F.col("_r") - F.col("_lo")).withColumn("_at", F.col("_part"))
             .drop(*renamed.values(), "_parent", "_part", "_c", "_hi", "_lo"))
    return t.drop("_r").withColumnRenamed("_at", "value")


def percentiles(df: DataFrame, col: str, ps: Sequence[float], by: Sequence[str] = (), count: str | None = None,
                bits: int = BITS) -> DataFrame:
    """Exact, linearly interpolated percentiles of an integer column: one row a
    group with the array ``q``.  ``count`` names a column of row counts if ``df``
    already is a histogram; it is then read as it is."""
    by, grouped = list(by) or ["_all"], bool(by)
    # without groups all rows are one, named in the histogram, so that ranks meet it by an equal key
    x = df if grouped else df.withColumn("_all", F.lit(0))
    hist = x if count else materialize(x.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_cnt")), "histogram")
    c = count or "_cnt"
    edge = hist.agg(F.min(F.col(col).cast("bigint")).alias("lo"), F.max(F.col(col).cast("bigint")).alias("hi")).first()
    full = hist.where(F.col(col).isNotNull())
    groups = hist.groupBy(*by).agg(F.sum(F.when(F.col(col).isNotNull(), F.col(c))).alias("_n"))
    p = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(x)).alias("p")) for i, x in enumerate(ps)]))
    x = groups.where("_n > 0").withColumn("_p", p).withColumn("_pos", F.col("_p.p") * (F.col("_n") - 1))
    x = x.withColumn("_r", F.explode(F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos")))))
    found = rank_values(full, x.select(*by, F.col("_p.i").alias("_i"), "_pos", "_r", F.col("_r").alias("_rank")), col, c, by,
                        passes(edge.lo, edge.hi, bits), bits)
    lo, hi = F.floor("_pos"), F.ceil("_pos")
    # a whole position has one value, another one both neighbours by their distance
    part = F.when(lo == hi, F.col("value")).when(F.col("_rank") == lo, (hi - F.col("_pos")) * F.col("value")).otherwise((F.col("_pos") - lo) * F.col("value"))
    q = found.groupBy(*by, "_i").agg(F.sum(part.cast("double")).alias("_q"))
    q = q.groupBy(*[F.col(b).alias(f"_g{i}") for i, b in enumerate(by)]).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_i", "_q"))), lambda s: s["_q"]).alias("q"))
    q = q.where(F.size("q") > 0)
    if not grouped:
        return q.agg(F.max("q").alias("q"))  # one row, also without values
    out = groups.join(q, _same(groups, q, {b: f"_g{i}" for i, b in enumerate(by)}), "left")
    return out.select(*by, "q")
