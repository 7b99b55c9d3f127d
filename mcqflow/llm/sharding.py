"""Byte-balanced contiguous shards from global prefix sums (DataFrame only).

Rows are range-partitioned by their order key, each partition sums its sizes,
the running totals of the partitions (one row a partition) give each partition
its base, and base + running sum inside the partition is the global byte
offset of a row.  A row goes to the shard in whose equal share of all bytes its
middle byte lies, so shards are contiguous in the order and their sizes differ
from the target by less than the largest row.

A last range key (a row number of the scan) splits a hot order key over many
partitions; it only decides among rows that are equal in all other keys.

Defined cases: null text has size 1 and crc 0; null doc_id sorts last; rows
with equal doc_id are ordered by crc and size; an empty table gives no rows;
extra columns pass through, columns named shard, slot or offset are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mcqflow.session import materialize


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text plus one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(1)


def text_crc32(text: str = "text") -> Column:
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).cast("long")


def assign(rows: DataFrame, n_shards: int = 8, size: str = "size", order: tuple[str, ...] = ("doc_id", "text_crc32", "size")) -> DataFrame:
    """``rows`` plus ``shard`` (0..n_shards-1), ``slot`` (gapless in its shard)
    and ``offset`` (bytes before the row)."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.drop("shard", "slot", "offset")
    keys = [F.col(c).asc_nulls_last() for c in order] + [F.col("__tie").asc()]
    cut = materialize(rows.withColumn("__tie", F.monotonically_increasing_id())
                      .repartitionByRange(parts, *keys)
                      .withColumn("__pid", F.spark_partition_id()), "shard-rows")
    # one row a partition: at most spark.sql.shuffle.partitions rows, a proven broadcast bound
    all_before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    bases = (cut.groupBy("__pid").agg(F.sum(size).alias("__b"), F.count(F.lit(1)).alias("__n"))
             .select("__pid", F.coalesce(F.sum("__b").over(all_before), F.lit(0)).alias("__b0"),
                     F.coalesce(F.sum("__n").over(all_before), F.lit(0)).alias("__n0"),
                     F.sum("__b").over(everything).alias("__total")))
    inside = Window.partitionBy("__pid").orderBy(*keys)
    placed = (cut.withColumn("__run", F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("__rn", F.row_number().over(inside))
              .join(F.broadcast(bases), "__pid")
              .withColumn("offset", F.col("__b0") + F.col("__run") - F.col(size))
              .withColumn("__i", F.col("__n0") + F.col("__rn") - 1)
              .withColumn("shard", F.least(F.lit(n_shards - 1).cast("long"),
                                           F.expr(f"((2 * offset + {size}) * {n_shards}) div (2 * __total)")).cast("int")))
    # one row a shard: at most n_shards rows
    starts = placed.groupBy("shard").agg(F.min("__i").alias("__first"))
    return (placed.join(F.broadcast(starts), "shard")
            .withColumn("slot", F.col("__i") - F.col("__first"))
            .select(*rows.columns, "shard", "slot", "offset"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder a shard, rows in slot order inside each file."""
    assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def report(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    rows = docs.select("doc_id", text_size().alias("size"), text_crc32().alias("text_crc32"))
    return assign(rows, n_shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                         F.lit(None).cast("int").alias("grown_shard"))
