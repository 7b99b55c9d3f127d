"""Cross-dataset de-duplication by case-insensitive fingerprint."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mcqflow.functions.text import blank_to_empty, norm
from mcqflow.session import materialize


def fingerprint(text="text", question="question", options="options") -> Column:
    """md5 of (lower(strip(text)), lower(strip(question)), lower(strip(options))),
    length-prefixed so that the encoding is unambiguous."""
    t = norm(blank_to_empty(text))
    q = norm(blank_to_empty(question))
    return F.md5(F.concat(F.length(t).cast("string"), F.lit(":"), t, F.lit("|"),
                          F.length(q).cast("string"), F.lit(":"), q, F.lit("|"),
                          F.coalesce(F.to_json(F.transform(F.col(options), lambda o: norm(o))), F.lit(""))))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once with ``_rid``, a number of its own for every row,
    equal rows included; all later passes see the same numbers."""
    return materialize(df.withColumn("_rid", F.monotonically_increasing_id()), name)


def later_rows(t: DataFrame, keys: Sequence[str], order: Sequence[str], ids: Sequence[str] = ("_rid",)) -> DataFrame:
    """``ids`` of the rows of a numbered table that are not the first of their
    keys (NULL keys are equal) by ``order`` (NULL last, then by row number).

    Only narrow rows are shuffled: the first of a key is a partial aggregate (a
    hot key is combined map-side), keys that occur once are dropped, and rows
    meet the firsts of the others in a join, which AQE turns into a broadcast
    or splits where a key is hot.  No window over a key.
    """
    pos = F.struct(*[c for o in order for c in (F.col(o).isNull().alias(f"{o}_null"), F.col(o))], F.col("_rid"))
    firsts = (t.groupBy(*keys).agg(F.min(pos)["_rid"].alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
              .select("_first", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]))
    rows = t.select(*dict.fromkeys([*keys, *ids, "_rid"]))
    on = [rows[k].eqNullSafe(firsts[f"_k{i}"]) for i, k in enumerate(keys)]
    return rows.join(firsts, on).where(F.col("_rid") != F.col("_first")).select(*ids)


def first_wins(df: DataFrame, key: str, order: Sequence[str], flag: str = "is_first") -> DataFrame:
    """Flags the first row of each key by ``order`` (see ``later_rows``); of
    equal rows one is first.  The rows are written once, so pass narrow ones."""
    t = numbered(df, "first-wins")
    later = later_rows(t, [key], order).withColumnRenamed("_rid", "_later")
    return (t.join(later, t["_rid"] == later["_later"], "left")
            .withColumn(flag, F.col("_later").isNull()).drop("_later", "_rid"))


def fingerprint_dedupe(df: DataFrame, order: Sequence[str] = ("grp_ord", "dataset_ord", "index")) -> DataFrame:
    """Adds ``fp`` (unless it is there) and ``is_first``; the first row of a
    fingerprint by group order, dataset order, line wins.  A NULL text or
    question counts as empty, NULL options as a value of their own."""
    return first_wins(df if "fp" in df.columns else df.withColumn("fp", fingerprint()), "fp", list(order))


def duplicate_stats(flagged: DataFrame, by: str = "grp", raw: DataFrame | None = None) -> DataFrame:
    """D3: per group, valid rows read, duplicates removed, rows available;
    with ``raw`` (the rows before validation) also ``raw_count``."""
    out = flagged.groupBy(by).agg(
        F.count(F.lit(1)).alias("original_count"),
        F.count_if(~F.col("is_first")).alias("duplicate_count"),
        F.count_if(F.col("is_first")).alias("available_count"))
    if raw is not None:
        r = raw.groupBy(by).agg(F.count(F.lit(1)).alias("raw_count"))
        out = r.join(out, by, "left").select(
            by, "raw_count", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                              for c in ("original_count", "duplicate_count", "available_count")])
    return out


def fingerprint_groups(flagged: DataFrame) -> DataFrame:
    """D4 in long form: one row per member of a fingerprint seen more than
    once, with the group size and the group's first index as its id.  Long
    form keeps a hot fingerprint from becoming one giant array."""
    sizes = flagged.groupBy("fp").agg(F.count(F.lit(1)).alias("fp_count"),
                                      F.min("index").alias("fp_id"))
    parts = [n if n in flagged.columns else c for n, c in group_lengths().items()]
    return flagged.join(sizes.where(F.col("fp_count") > 1), "fp").select("fp_id", "fp_count", "source", *parts, "label", "index")


def group_lengths() -> dict[str, Column]:
    """The lengths that a fingerprint group reports, of the normalised parts."""
    cols = {"text_length": F.length(norm(blank_to_empty("text"))), "question_length": F.length(norm(blank_to_empty("question"))),
            "options_count": F.size("options")}
    return {n: c.cast("bigint").alias(n) for n, c in cols.items()}


def unique_fingerprints(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.count_distinct("fp").alias("total_unique_fingerprints"))


def incremental_dedupe(new: DataFrame, accepted: DataFrame, key: str = "fp") -> DataFrame:
    """Rows of ``new`` whose key is not among ``accepted`` (left anti join)."""
    return new.join(accepted.select(key).distinct(), key, "left_anti")
