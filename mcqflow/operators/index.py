"""Exact ranks without a single-task window.

``row_number() over (order by k)`` with no partition runs in one task.  Here
the order key is cut into ordered buckets (a prefix of a hex hash, or row
quantiles of an integer position); per-bucket counts give a running offset over a small
table (groups x buckets rows), which is broadcast back; the rank is the offset
plus ``row_number`` inside the bucket.  Result equals the plain global window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Upper bound on rows of a table we broadcast.  Offset tables have
# (#partition keys x #buckets) rows; above this they are shuffled instead.
BROADCAST_ROW_LIMIT = 2_000_000
# 16^4 = 65,536 hash buckets: ~1.5M rows per window task at 1e11 rows.
HEX_DIGITS = 4
# Integer positions are cut at row quantiles into buckets of about 2^20 rows, or
# more where that would be more than MAX_INT_BUCKETS buckets.
INT_BUCKET_WIDTH = 1 << 20
MAX_INT_BUCKETS = 4096


def seeded_hash(seed, *keys) -> Column:
    """md5 of 'seed:key1:key2...' -- the seeded shuffle order (same in DuckDB)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]))


def hex_bucket(h: Column, digits: int = HEX_DIGITS) -> Column:
    """Ordered bucket of a hex string: its first ``digits`` characters."""
    return F.substring(h, 1, digits)


def int_bucket(df: DataFrame, pos: str, width: int = INT_BUCKET_WIDTH, most: int = MAX_INT_BUCKETS) -> Column:
    """Ordered bucket of an integer column: about ``width`` rows each or more, at
    most ``most`` + 1 buckets however the values are spread; equal values share
    one.  The cuts (at most ``most`` numbers) are read once, so every use of the
    column has the same ones."""
    v = F.col(pos).cast("double")
    if df.agg(F.count(v)).first()[0] <= width:  # one bucket: no quantiles needed
        return F.when(v.isNotNull(), F.lit(0)).cast("bigint")
    r = df.agg(F.count(v).alias("n"), F.percentile_approx(v, [k / most for k in range(1, most)], 4 * most).alias("cuts")).first()
    n = max(1, min(most, -(-r.n // width)))
    cuts = sorted({r.cuts[k * most // n - 1] for k in range(1, n)})
    if not cuts:
        return F.when(v.isNotNull(), F.lit(0)).cast("bigint")
    steps = [1 << k for k in range(len(cuts).bit_length() - 1, -1, -1)]
    at = F.split(F.lit(",".join(map(repr, cuts))), ",").cast("array<double>")
    # binary search: the number of cuts below the value
    below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0),
                        lambda i, k: F.when((i + k <= len(cuts)) & (F.get(at, i + k - 1) < v), i + k).otherwise(i))
    return F.when(v.isNotNull(), below).cast("bigint")


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               bound: int | None = None, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Join with a side that is broadcast only behind a size check.

    ``bound`` is a proven upper bound on the rows of ``small`` (e.g. #groups
    x #buckets, known from configuration).  Within ``limit`` it is broadcast;
    otherwise the plain join is planned and AQE may still switch it to a
    broadcast after measuring the materialised side at run time.
    """
    if bound is not None and bound <= limit:
        small = F.broadcast(small)  # proven: at most ``bound`` rows
    return big.join(small, on, how)


def with_offsets(df: DataFrame, bucket: Column, partition: Sequence[str] = (), max_keys: int | None = 1,
                 n_buckets: int | None = 16 ** HEX_DIGITS) -> DataFrame:
    """Adds ``_bk`` (the bucket), ``_n`` (rows of the partition's bucket) and
    ``_off`` (rows of the partition in the buckets before it)."""
    part = list(partition)
    b = df.withColumn("_bk", bucket)
    counts = b.groupBy(*part, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    w_off = (Window.partitionBy(*part).orderBy("_bk")
             .rowsBetween(Window.unboundedPreceding, -1))
    # null-safe: rows with a NULL order or partition key keep their rank
    keys = part + ["_bk"]
    offsets = counts.select("_n", F.coalesce(F.sum("_n").over(w_off), F.lit(0)).cast("bigint").alias("_off"),
                            *[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)])
    bound = max_keys * n_buckets if (max_keys and n_buckets) else None
    on = [b[k].eqNullSafe(offsets[f"_o{i}"]) for i, k in enumerate(keys)]
    return join_small(b, offsets, on, bound=bound).drop(*[f"_o{i}" for i in range(len(keys))])


def ranked(df: DataFrame, order: Sequence[str], bucket: Column,
           partition: Sequence[str] = (), name: str = "rn",
           max_keys: int | None = 1, n_buckets: int | None = 16 ** HEX_DIGITS) -> DataFrame:
    """Adds ``name`` = 1-based row_number over (partition by ``partition``
    order by ``order``).

    ``bucket`` must be non-decreasing in ``order`` within each partition.  The
    window runs per (partition, bucket), so no task holds a whole group.
    """
    part = list(partition)
    joined = with_offsets(df, bucket, part, max_keys, n_buckets)
    w = Window.partitionBy(*part, "_bk").orderBy(*order)
    return (joined.withColumn(name, (F.row_number().over(w) + F.col("_off")).cast("bigint"))
            .drop("_bk", "_off", "_n"))
