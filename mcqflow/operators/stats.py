"""Distribution reports: counts, shares, length statistics, histograms.

Every report is a DataFrame.  Exact percentiles go through a (value, count)
histogram, so no task ever holds all rows of a group.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mcqflow.operators.sample import QUINTILE_LABELS, length_percentiles
from mcqflow.operators.select import percentiles
from mcqflow.session import materialize


def counts(df: DataFrame, *keys, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def share(df: DataFrame, key: str, digits: int = 6) -> DataFrame:
    """Count and percentage per key; the total is a scalar subquery."""
    c = counts(df, key)
    total = df.agg(F.count(F.lit(1)).alias("t")).select("t").scalar()
    return c.withColumn("pct", F.round(F.col("n") * 100.0 / total, digits))


def length_distribution(df: DataFrame, col: str) -> DataFrame:
    """A5: quintile bin counts (right-closed qcut bins); when two edges are
    equal: min, max, mean and the upper median instead.  (key, value)."""
    df = df.withColumn(col, F.coalesce(F.col(col), F.lit(0)))  # no text: length 0
    v = F.col(col)
    e = length_percentiles(df, col, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]).select("q").scalar()
    ok = F.size(F.array_distinct(e)) == 6
    b = (F.when(v <= e[1], QUINTILE_LABELS[0]).when(v <= e[2], QUINTILE_LABELS[1])
         .when(v <= e[3], QUINTILE_LABELS[2]).when(v <= e[4], QUINTILE_LABELS[3])
         .otherwise(QUINTILE_LABELS[4]))
    quint = (df.select(b.alias("key")).groupBy("key").agg(F.count(F.lit(1)).cast("double").alias("value"))
             .where(ok))
    hist = df.groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    n = hist.agg(F.sum("_c").alias("n")).select("n").scalar()
    # cumulative counts over distinct values only (bounded by the value range)
    cum = hist.withColumn("_cum", F.sum("_c").over(Window.orderBy(col)))
    median = cum.where(F.col("_cum") >= F.floor(n / 2) + 1).agg(F.min(col).cast("double").alias("value"))
    st = df.agg(F.min(v).cast("double").alias("min"), F.max(v).cast("double").alias("max"),
                F.round(F.avg(v), 6).alias("mean"))
    fallback = (st.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value"))
                                              for k in ("min", "max", "mean")])).alias("s"))
                .select("s.key", "s.value")
                .unionByName(median.select(F.lit("median").alias("key"), "value"))
                .where(~ok))
    return quint.unionByName(fallback)


def label_optcount_distribution(df: DataFrame) -> DataFrame:
    """A4: (opt_count, label) counts with the opt_count group total."""
    c = df.groupBy(F.size("options").cast("bigint").alias("opt_count"), "label").agg(
        F.count(F.lit(1)).alias("count"))
    tot = c.groupBy("opt_count").agg(F.sum("count").alias("total"))
    # both sides are aggregates; the planner/AQE picks the join strategy
    return c.join(tot, "opt_count")


def overall_length_stats(lengths: DataFrame, col: str = "length") -> DataFrame:
    """N, datasets, min, max, mean, median."""
    med = length_percentiles(lengths, col, [0.5]).select(F.col("q")[0].alias("median"))
    a = lengths.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("dataset").alias("datasets"),
                    F.min(col).alias("min"), F.max(col).alias("max"),
                    F.round(F.avg(col), 6).alias("mean"))
    return a.withColumn("median", F.round(med.select("median").scalar(), 6))


def per_dataset_length_stats(lengths: DataFrame, col: str = "length") -> DataFrame:
    """Per dataset n, min, max, mean, median, std (ddof 1), Q1, Q3."""
    q = length_percentiles(lengths, col, [0.25, 0.5, 0.75], ["dataset"])
    a = lengths.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n"), F.min(col).alias("min"), F.max(col).alias("max"),
        F.round(F.avg(col), 6).alias("mean"), F.round(F.stddev_samp(col), 6).alias("std"))
    return a.join(q, "dataset").select(
        "dataset", "n", "min", "max", "mean", F.round(F.col("q")[1], 6).alias("median"), "std",
        F.round(F.col("q")[0], 6).alias("q1"), F.round(F.col("q")[2], 6).alias("q3"))


# Length buckets [0,500), [500,1000), [1000,2000), [2000,5000),
# [5000, inf) and their report labels.
BUCKET_EDGES = [0, 500, 1000, 2000, 5000]
BUCKET_LABELS = ["0-500", "501-1000", "1001-2000", "2001-5000", "5000+"]


def length_bucket(v: Column) -> Column:
    """Left-closed fixed buckets (500 falls in '501-1000', as in the source report)."""
    return (F.when(v < 500, BUCKET_LABELS[0]).when(v < 1000, BUCKET_LABELS[1])
            .when(v < 2000, BUCKET_LABELS[2]).when(v < 5000, BUCKET_LABELS[3])
            .otherwise(BUCKET_LABELS[4]))


def bucket_shares(lengths: DataFrame, col: str = "length") -> DataFrame:
    """Per dataset and overall ('ALL'), count and % per bucket."""
    b = lengths.withColumn("bucket", length_bucket(F.col(col)))
    per = b.groupBy("dataset", "bucket").agg(F.count(F.lit(1)).alias("n"))
    tot = b.groupBy("dataset").agg(F.count(F.lit(1)).alias("_t"))
    per = per.join(tot, "dataset")
    allb = b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "_t", b.agg(F.count(F.lit(1)).alias("t")).select("t").scalar()).withColumn("dataset", F.lit("ALL"))
    out = per.unionByName(allb)
    return out.select("dataset", "bucket", "n", F.round(F.col("n") * 100.0 / F.col("_t"), 6).alias("pct"))


def box_stats(lengths: DataFrame, col: str = "length", by: str = "dataset") -> DataFrame:
    """Per dataset median, Q1, Q3, whiskers (most extreme values within
    1.5 IQR of the box) and flier count."""
    hist = materialize(lengths.groupBy(by, col).agg(F.count(F.lit(1)).alias("_n")), "histogram")  # all that follows reads it
    q = percentiles(hist, col, [0.25, 0.5, 0.75], [by], count="_n").select(
        F.col(by).alias("_by"), F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.withColumn("lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    x = hist.join(q, F.col(by).eqNullSafe(F.col("_by")))
    v = F.col(col)
    inside = (v >= F.col("lo")) & (v <= F.col("hi"))
    return x.groupBy(by).agg(
        F.round(F.first("median"), 6).alias("median"), F.round(F.first("q1"), 6).alias("q1"),
        F.round(F.first("q3"), 6).alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("fliers"))


def histogram(lengths: DataFrame, col: str, lo: Column, hi: Column, n_edges: int,
              by: Sequence[str] = ()) -> DataFrame:
    """np.histogram with ``n_edges`` evenly spaced edges on [lo, hi]: bins are
    left-closed, the last one closed; values outside are dropped."""
    nb = n_edges - 1
    v = F.col(col).cast("double")
    b = F.when(v == hi, F.lit(nb - 1)).otherwise(F.floor((v - lo) * (F.lit(float(nb)) / (hi - lo)))).cast("bigint")
    x = lengths.where((v >= lo) & (v <= hi)).withColumn("bin", b)
    return x.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))


# ---- shuffle quality over an ordered set (position column ``pos``, 0-based) --

def _source_list(df: DataFrame, source: str = "source") -> Column:
    """Sorted distinct sources as a scalar array (bounded by #sources)."""
    return df.agg(F.sort_array(F.collect_set(source)).alias("s")).select("s").scalar()


def chunk_source_counts(df: DataFrame, pos: str = "pos", chunk: int = 100, first: int | None = None,
                        source: str = "source") -> DataFrame:
    """A10 + J5: counts per (chunk, source), zero cells included, with % of
    the chunk; all chunks, or the first ``first`` for a chart (O5)."""
    x = (df if first is None else df.where(F.col(pos) < chunk * first)).withColumn("chunk", F.floor(F.col(pos) / chunk).cast("bigint"))
    c = x.groupBy("chunk", source).agg(F.count(F.lit(1)).alias("n"))
    sizes = x.groupBy("chunk").agg(F.count(F.lit(1)).alias("_t"))
    grid = sizes.select("chunk", "_t", F.explode(_source_list(df, source)).alias(source))
    return (grid.join(c, ["chunk", source], "left")
            .select("chunk", source, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
                    F.round(F.coalesce("n", F.lit(0)) * 100.0 / F.col("_t"), 6).alias("pct")))


def shuffle_header(df: DataFrame, chunk: int = 100, source: str = "source") -> DataFrame:
    """Rows, chunk size, number of chunks, number of sources."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(chunk).cast("bigint").alias("chunk_size"),
                  F.ceil(F.count(F.lit(1)) / chunk).cast("bigint").alias("chunks"),
                  F.count_distinct(source).alias("sources"))


def source_trend(df: DataFrame, pos: str = "pos", chunk: int = 100, window: int = 5,
                 stride: int | None = None, source: str = "source") -> DataFrame:
    """Average count per chunk of each source, per window.

    Tumbling (default): window w covers rows [w*chunk*window, (w+1)*chunk*window).
    ``stride`` given (it divides chunk*window): window w covers rows
    [w*stride, w*stride + chunk*window) for every w with w*stride < #rows.
    Rows are counted per block of ``stride`` rows; a window's count is the
    difference of two running totals of its source.  Zero cells included;
    positions are dense, so the windows are those of the blocks.
    """
    span = chunk * window
    size = span if stride is None else stride
    c = (df.groupBy(F.floor(F.col(pos) / size).cast("bigint").alias("window"), source)
         .agg(F.count(F.lit(1)).alias("_c")))
    grid = c.select("window").distinct().select("window", F.explode(_source_list(df, source)).alias(source))
    grid = grid.join(c, ["window", source], "left").withColumn("_c", F.coalesce("_c", F.lit(0)))
    if stride is not None:
        grid = _window_sums(grid, span // stride, source)
    return grid.select("window", source, F.round(F.col("_c") / F.lit(float(window)), 6).alias("avg_per_chunk"))


BLOCKS_PER_TASK = 1 << 16


def _window_sums(grid: DataFrame, per: int, source: str) -> DataFrame:
    """``_c`` of each (source, window) summed over the windows window .. window +
    per - 1.  Running totals are taken per stretch of ``BLOCKS_PER_TASK`` windows
    and start from the prefix sums of the stretches, so no task holds a source."""
    x = materialize(grid.withColumn("_g", F.floor(F.col("window") / BLOCKS_PER_TASK)), "trend-blocks")
    before = Window.partitionBy(source).orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    base = (x.groupBy(source, "_g").agg(F.sum("_c").alias("_s"))
            .select(source, "_g", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"),
                    F.sum("_s").over(Window.partitionBy(source)).alias("_all")))
    inside = Window.partitionBy(source, "_g").orderBy("window").rowsBetween(Window.unboundedPreceding, 0)
    run = materialize(x.withColumn("_run", F.sum("_c").over(inside)).join(base, [source, "_g"])
                      .select("window", source, "_c", (F.col("_run") + F.col("_before")).alias("_run"), "_all"), "trend-totals")
    end = run.select((F.col("window") - (per - 1)).alias("window"), source, F.col("_run").alias("_end")).where("window >= 0")
    return run.join(end, ["window", source], "left").select(  # windows past the end reach to the last row
        "window", source, (F.coalesce("_end", "_all") - F.col("_run") + F.col("_c")).alias("_c"))


def shuffle_uniformity(df: DataFrame, source: str = "source") -> DataFrame:
    """Sample std and CV of per-source counts; good iff CV < 0.5."""
    c = df.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    return c.agg(F.round(F.stddev_samp("n"), 6).alias("std"), F.round(F.avg("n"), 6).alias("mean"),
                 F.round(F.stddev_samp("n") / F.avg("n"), 6).alias("cv"),
                 (F.stddev_samp("n") / F.avg("n") < 0.5).alias("good"))


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Counts in frequency-descending order as an explicit ``rank``
    (ties by key).  The window runs over the aggregated table only (one row
    per distinct key)."""
    c = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc(key))).cast("bigint"))


def order_by_median(lengths: DataFrame, col: str = "length", by: str = "dataset") -> DataFrame:
    """O3: datasets ranked by median length (ties by name)."""
    m = length_percentiles(lengths, col, [0.5], [by]).select(by, F.col("q")[0].alias("median"))
    return m.select(by, F.round("median", 6).alias("median"),
                    F.row_number().over(Window.orderBy("median", by)).cast("bigint").alias("rank"))


def kde_grid(lengths: DataFrame, col: str = "length", by: str = "dataset", upper: Column | None = None,
             grid: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian density per group on ``grid`` evenly spaced points from
    min - cut*h to max + cut*h, h = sample std * n^(-1/5) (Scott).

    The input is first reduced to a (group, value, count) histogram; each
    histogram row is spread over the grid points (``grid`` per distinct
    value, bounded by the value range, not the row count) and summed per
    grid point.  Groups with fewer than 2 rows or no spread are skipped.
    """
    import math
    x = lengths if upper is None else lengths.where(F.col(col) <= upper)
    v = F.col(col).cast("double")
    hist = x.groupBy(by, col).agg(F.count(F.lit(1)).alias("_c"))
    st = (x.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp(v).alias("_sd"),
                            F.min(v).alias("_mn"), F.max(v).alias("_mx"))
          .where((F.col("_n") >= 2) & (F.col("_sd") > 0))
          .withColumn("_h", F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2))))
    st = (st.withColumn("_lo", F.col("_mn") - cut * F.col("_h"))
          .withColumn("_hi", F.col("_mx") + cut * F.col("_h"))
          .withColumn("_step", (F.col("_hi") - F.col("_lo")) / (grid - 1)))
    e = (hist.join(st, by).select(by, v.alias("_v"), "_c", "_n", "_h", "_lo", "_hi", "_step",
                                  F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("gi")))
    xg = F.when(F.col("gi") == grid - 1, F.col("_hi")).otherwise(F.col("_lo") + F.col("gi") * F.col("_step"))
    e = e.withColumn("_x", xg).withColumn(
        "_k", F.col("_c") * F.exp(F.lit(-0.5) * F.pow((F.col("_x") - F.col("_v")) / F.col("_h"), F.lit(2.0))))
    out = e.groupBy(by, "gi", "_x", "_n", "_h").agg(F.sum("_k").alias("_s"))
    dens = F.col("_s") / (F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi)))
    return out.select(by, F.col("gi").cast("bigint").alias("gi"), F.round("_x", 6).alias("x"),
                      F.round(dens * 1e6, 6).alias("density_e6"))
