"""Exact-size draws, seeded shuffle, length fences, outlier filter, split.

Randomness is an md5 order over (seed, key): the same in every engine and
independent of partitioning.  Ranks come from ``index.ranked`` (bucketed), so
no draw needs a single-task window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mcqflow.functions.text import total_length, blank_to_empty
from mcqflow.operators.index import hex_bucket, join_small, ranked, seeded_hash, with_offsets
from mcqflow.operators.select import percentiles

SEED = 42
QUINTILE_LABELS = ["very_short", "short", "medium", "long", "very_long"]


def _num(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# ---- ordering -------------------------------------------------------------

def with_shuffle_rank(df: DataFrame, keys: Sequence[str], seed=SEED,
                      partition: Sequence[str] = (), name: str = "rn",
                      max_keys: int | None = 1) -> DataFrame:
    """1-based rank in md5('seed:key...') order, per ``partition``.
    ``max_keys`` bounds the number of partition keys (None = unknown)."""
    h = seeded_hash(seed, *keys)
    return ranked(df.withColumn("_h", h), ["_h"], hex_bucket(F.col("_h")), partition, name,
                  max_keys=max_keys).drop("_h")


def draw_per_group(df: DataFrame, target: Column, keys: Sequence[str], partition: Sequence[str],
                   seed=SEED, max_keys: int | None = None) -> DataFrame:
    """Per group, the first ``target`` rows in seeded order (all rows when
    the group is short).  ``target`` is a column (per-row group target).

    Counting selection: the rows of each (group, hash bucket) are counted; all
    rows of the buckets that end within the target are taken as they are, and
    only the one bucket that the target cuts is ranked."""
    x = df.withColumn("_h", seeded_hash(seed, *keys)).withColumn("_t", target)
    x = with_offsets(x, hex_bucket(F.col("_h")), partition, max_keys).where(F.col("_off") < F.col("_t"))
    whole = F.col("_off") + F.col("_n") <= F.col("_t")
    in_bucket = Window.partitionBy(*partition, "_bk").orderBy("_h")
    cut = (x.where(~whole).withColumn("_rn", F.row_number().over(in_bucket) + F.col("_off"))
           .where(F.col("_rn") <= F.col("_t")))
    return x.where(whole).select(*df.columns).unionByName(cut.select(*df.columns))


def ratio_mix(df: DataFrame, groups: DataFrame, total, keys=("dataset", "index"),
              seed=SEED, max_groups: int | None = None) -> DataFrame:
    """M1: per group take floor(total * ratio) rows uniformly without
    replacement, or all of them when the group is short.

    ``groups`` (grp, ratio, ...) is the group configuration -- a handful of
    rows, broadcast.  ``total`` is an int or a scalar column.
    """
    g = groups.select("grp", "ratio")
    # the configuration table is counted (a handful of rows): a proven bound
    # for its broadcast and for the number of groups that reach the draw
    n_groups = min(g.count(), max_groups) if max_groups else g.count()
    x = join_small(df, g, ["grp"], bound=n_groups)
    target = F.floor(_num(total) * F.col("ratio")).cast("bigint")
    return draw_per_group(x.withColumn("target", target), F.col("target"), list(keys), ["grp"], seed,
                          max_keys=n_groups)


def group_targets(df: DataFrame, groups: DataFrame, total) -> DataFrame:
    """A24 (draw part): per group available rows, target, drawn, short flag."""
    avail = df.groupBy("grp").agg(F.count(F.lit(1)).alias("available"))
    t = groups.select("grp", F.floor(_num(total) * F.col("ratio")).cast("bigint").alias("target"))
    return (t.join(avail, "grp", "left")
            .select("grp", "target", F.coalesce("available", F.lit(0)).cast("bigint").alias("available"),
                    F.least(F.col("target"), F.coalesce("available", F.lit(0))).cast("bigint").alias("drawn"),
                    (F.coalesce("available", F.lit(0)) < F.col("target")).alias("short")))


# ---- exact percentiles -----------------------------------------------------

def length_percentiles(df: DataFrame, col: str, ps: Sequence[float],
                       by: Sequence[str] = ()) -> DataFrame:
    """Exact (linear-interpolated) percentiles of an integer column, by radix
    selection on its histogram: no task holds all distinct values of a group."""
    return percentiles(df, col, ps, by)


def fence_stats(df: DataFrame, col: str = "length", by: Sequence[str] = ()) -> DataFrame:
    """q1, median, q3, iqr, upper = q3 + 1.5 iqr (exact)."""
    q = length_percentiles(df, col, [0.25, 0.5, 0.75], by)
    return q.select(*by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                    F.col("q")[2].alias("q3"), (F.col("q")[2] - F.col("q")[0]).alias("iqr"),
                    (F.col("q")[2] + F.lit(1.5) * (F.col("q")[2] - F.col("q")[0])).alias("upper"))


def with_total_length(df: DataFrame, name: str = "length") -> DataFrame:
    return df.withColumn(name, total_length())


def outlier_flag(df: DataFrame, col: str = "length") -> DataFrame:
    """M4: ``is_outlier`` iff length > Q3 + 1.5 IQR over the whole input (no
    lower fence).  The fence is a scalar subquery."""
    upper = fence_stats(df, col).select("upper").scalar()
    return df.withColumn("is_outlier", F.col(col) > upper)


def outlier_filter(df: DataFrame, col: str = "length") -> DataFrame:
    return outlier_flag(df, col).where(~F.col("is_outlier")).drop("is_outlier")


def outlier_rows(df: DataFrame, col: str = "length") -> DataFrame:
    """Outlier report rows: length parts and source."""
    return (outlier_flag(df, col).where("is_outlier")
            .select("index", "source", F.col(col).alias("length"),
                    *[n if n in df.columns else c for n, c in length_parts().items()]))


def length_parts() -> dict[str, Column]:
    """The parts of the total length."""
    cols = {"text_length": F.length(blank_to_empty("text")), "question_length": F.length(blank_to_empty("question")),
            "options_length": F.aggregate("options", F.lit(0).cast("bigint"), lambda a, o: a + F.length(o))}
    return {n: c.cast("bigint").alias(n) for n, c in cols.items()}


def outlier_refill(drawn: DataFrame, available: DataFrame, col: str = "length",
                   keys=("dataset", "index"), seed=SEED, max_groups: int = 64) -> DataFrame:
    """M5: per group, drop rows above the group's fence and refill as many
    as were dropped from the group's in-bound rows not already drawn.

    The pool is anti-joined against the draw first, so a refill never repeats
    a kept row.  Fences are per group: a (groups x 5) table.
    """
    f = fence_stats(drawn, col, ["grp"]).select("grp", "upper")
    d = join_small(drawn, f, ["grp"], bound=max_groups)
    kept = d.where(F.col(col) <= F.col("upper"))
    need = (d.groupBy("grp").agg(F.count_if(F.col(col) > F.col("upper")).alias("need")))
    pool = (join_small(available, f, ["grp"], bound=max_groups).where(F.col(col) <= F.col("upper"))
            .join(drawn.select(*keys), list(keys), "left_anti"))
    pool = join_small(pool, need, ["grp"], bound=max_groups)
    refill = draw_per_group(pool, F.col("need"), list(keys), ["grp"], seed, max_keys=max_groups)
    cols = [c for c in drawn.columns if c in set(available.columns)]
    return (kept.select(*cols).withColumn("refilled", F.lit(False))
            .unionByName(refill.select(*cols).withColumn("refilled", F.lit(True))))


# ---- split ----------------------------------------------------------------

def split_flags(df: DataFrame, keys=("dataset", "index"), seed=SEED,
                ratios=(0.9, 0.45, 0.1)) -> DataFrame:
    """M3: shuffle, then eval = last floor(.1 n); full = first floor(.9 n) of
    the rest; peft = first floor(.45 n) (a subset of full).  n < 10 keeps all
    rows in train.  A row in neither full nor eval is ``unassigned``."""
    full_r, peft_r, eval_r = ratios
    r = with_shuffle_rank(df, keys, seed, (), "rn")
    n = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    n_eval = F.floor(n * F.lit(float(eval_r)))
    n_full = F.floor(n * F.lit(float(full_r)))
    n_peft = F.floor(n * F.lit(float(peft_r)))
    is_eval = F.col("rn") > n - n_eval
    return (r.withColumn("is_eval", is_eval)
            .withColumn("is_full", ~is_eval & ((F.col("rn") <= n_full) | (n < 10)))
            .withColumn("is_peft", ~is_eval & (F.col("rn") <= n_peft))
            .withColumn("split", F.when(F.col("is_eval"), "eval").when(F.col("is_full"), "train")
                        .otherwise("unassigned")))


# ---- stratified sample ----------------------------------------------------

def quintile_edges(df: DataFrame, col: str) -> DataFrame:
    """pandas.qcut(q=5) edges: exact percentiles 0, .2, .4, .6, .8, 1."""
    return length_percentiles(df, col, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])


def with_quintile_bin(df: DataFrame, col: str, name: str = "length_bin") -> DataFrame:
    """Right-closed bins on the quintile edges (lowest value included);
    equal edges leave a bin empty (merged)."""
    e = quintile_edges(df, col).select("q").scalar()
    v = F.col(col)
    b = (F.when(v <= e[1], QUINTILE_LABELS[0]).when(v <= e[2], QUINTILE_LABELS[1])
         .when(v <= e[3], QUINTILE_LABELS[2]).when(v <= e[4], QUINTILE_LABELS[3])
         .otherwise(QUINTILE_LABELS[4]))
    return df.withColumn(name, b)


def stratified_sample(df: DataFrame, target: int, keys=("dataset", "index"), seed=SEED) -> DataFrame:
    """M2: strata = source x option count x text-length quintile; each stratum
    gets floor(target * share), all of it when short."""
    made = {"opt_count": F.size("options"), "text_length": F.length(blank_to_empty("text"))}
    x = with_quintile_bin(df.withColumns({n: c for n, c in made.items() if n not in df.columns}), "text_length")
    x = x.withColumn("stratum", F.concat_ws("_", "source", "opt_count", "length_bin"))
    n = x.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    sizes = x.groupBy("stratum").agg(F.count(F.lit(1)).alias("_s"))
    x = join_small(x, sizes, ["stratum"], bound=None)
    t = target.cast("double") if isinstance(target, Column) else F.lit(float(target))
    x = x.withColumn("stratum_target", F.floor(t * (F.col("_s") / n)).cast("bigint"))
    return draw_per_group(x, F.col("stratum_target"), list(keys), ["stratum"], seed).drop("_s")
