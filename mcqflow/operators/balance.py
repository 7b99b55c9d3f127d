"""Answer-position balancing without changing answers.

Within each option-count group the rows, in input order, get target labels
0, 1, ..., k-1, 0, 1, ... -- which is exactly what a greedy 'least-used label
first' assignment with quotas floor(n/k) (+1 for the first n mod k labels)
produces.  The right option is swapped into the target slot; no row dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mcqflow.operators.dedup import numbered
from mcqflow.operators.index import int_bucket, ranked
from mcqflow.operators.stats import label_optcount_distribution

MAX_OPTION_COUNT = 64  # bound on distinct option counts (partition keys)


def balance_labels(df: DataFrame, order: str = "index") -> DataFrame:
    """B1: adds ``target`` and returns options/label after the swap, plus
    ``answer_kept`` (B2: options[label] equals the old right answer).

    The rows are written once with a number; only narrow keys are ranked, as a
    window task holds up to a bucket of about 2^20 rows, and ranks meet the rows
    by number."""
    x = numbered(df.withColumn("opt_count", F.size("options")), "unbalanced")
    keys = x.select(*dict.fromkeys(["_rid", order, "opt_count"]))
    pos = ranked(keys, [order, "_rid"], int_bucket(keys, order), ["opt_count"], "_pos",
                 max_keys=MAX_OPTION_COUNT, n_buckets=None)
    x = x.join(pos.select("_rid", "_pos"), "_rid")
    x = x.withColumn("target", F.pmod(F.col("_pos") - 1, F.col("opt_count")).cast("bigint"))
    old = F.col("options")
    lab = F.col("label").cast("int")
    tgt = F.col("target").cast("int")
    swapped = F.transform(old, lambda o, i: F.when(i == tgt, F.get(old, lab))
                          .when(i == lab, F.get(old, tgt)).otherwise(o))
    answer = F.get(old, lab)
    return (x.withColumn("answer_text", answer)
            .withColumn("options", swapped)
            .withColumn("original_label", F.col("label"))
            .withColumn("label", F.col("target"))
            .withColumn("answer_kept", F.get(F.col("options"), tgt) == F.col("answer_text"))
            .drop("_rid", "_pos", "answer_text"))


def balance_report(before: DataFrame, after: DataFrame, digits: int = 6) -> DataFrame:
    """Per (opt_count, label) counts and % before and after; labels seen
    on one side only count 0 on the other (full outer join)."""
    b = label_optcount_distribution(before).select(
        "opt_count", "label", F.col("count").alias("before"), F.col("total").alias("before_total"))
    a = label_optcount_distribution(after).select(
        "opt_count", "label", F.col("count").alias("after"), F.col("total").alias("after_total"))
    j = b.join(a, ["opt_count", "label"], "full_outer")
    tb = F.max("before_total").over(Window.partitionBy("opt_count"))
    ta = F.max("after_total").over(Window.partitionBy("opt_count"))
    return j.select(
        "opt_count", "label",
        F.coalesce("before", F.lit(0)).cast("bigint").alias("before"),
        F.round(F.coalesce("before", F.lit(0)) * 100.0 / tb, digits).alias("before_pct"),
        F.coalesce("after", F.lit(0)).cast("bigint").alias("after"),
        F.round(F.coalesce("after", F.lit(0)) * 100.0 / ta, digits).alias("after_pct"))
