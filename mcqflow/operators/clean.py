"""Converter cleaning: ordered reject reasons, option merge, in-dataset de-dup.

``classify`` attaches one ``reason`` per row (NULL = valid), the first rule
that fires in the fixed precedence of ``schema.REASONS``.  Rows are never
dropped here; callers filter on ``reason``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mcqflow.functions.text import ALNUM_PATTERN, blank_to_empty, norm, py_strip
from mcqflow.operators.dedup import later_rows, numbered
from mcqflow.schema import NOTE_DEDUPED


def _dup_key(text: Column, question: Column, options: Column) -> Column:
    """md5 over a length-prefixed encoding of (text, question, options): a
    fixed-width shuffle key instead of long text (collision odds ~n^2/2^129);
    the prefixes make the encoding unambiguous without escaping the text."""
    return F.md5(F.concat(F.length(text).cast("string"), F.lit(":"), text, F.lit("|"),
                          F.length(question).cast("string"), F.lit(":"), question, F.lit("|"),
                          F.to_json(options)))


def same_ignoring_case(a: Column, b: Column) -> Column:
    """lower(a) = lower(b), with a length guard first: lower() at most doubles
    a string's length, so long texts never get lower-cased against short
    questions (And short-circuits)."""
    la, lb = F.length(a), F.length(b)
    return (la <= lb * 2) & (lb <= la * 2) & (F.lower(a) == F.lower(b))


def option_columns(df: DataFrame, options: str = "options") -> DataFrame:
    """Adds ``_opts_s`` (stripped), ``_lows`` (stripped+lower), ``_has_dup``,
    ``_uniq`` (first spelling of each case-insensitive option)."""
    o = F.col(options)
    return (df
            .withColumn("_opts_s", F.transform(o, lambda x: py_strip(x)))
            .withColumn("_lows", F.transform("_opts_s", lambda x: F.lower(x)))
            .withColumn("_n_uniq", F.size(F.array_distinct("_lows")))
            .withColumn("_has_dup", F.col("_n_uniq") < F.size("_lows"))
            .withColumn("_uniq", F.filter("_opts_s", lambda x, i:
                                          F.array_position("_lows", F.lower(x)) == i + 1)))


def option_valid_flags(df: DataFrame, options: str = "options") -> DataFrame:
    """Per-option validity (P1): ``option_ok`` array<boolean>, ``all_ok``."""
    return (df.withColumn("option_ok", F.transform(options, lambda x: x.rlike(ALNUM_PATTERN)))
            .withColumn("all_ok", F.forall("option_ok", lambda b: b)))


def annotate(df: DataFrame) -> DataFrame:
    """The rules on one row: ``reason`` (NULL = none fires), the repaired
    options/label, ``original_options``/``original_label`` (NULL if untouched),
    ``note``, and ``_key``, the sample's identity (NULL on a rejected row)."""
    x = option_columns(df)
    opts = F.col("options")
    label = F.col("label")
    text_s = py_strip(blank_to_empty("text"))
    question_s = py_strip(blank_to_empty("question"))
    x = x.withColumn("_text_s", text_s).withColumn("_question_s", question_s)

    other = (opts.isNull() | (F.size(opts) == 0)
             | F.exists(opts, lambda o: o.isNull() | (py_strip(o) == "")))
    invalid_opt = F.exists("_opts_s", lambda o: ~o.rlike(ALNUM_PATTERN))
    dup_opts = F.col("_has_dup") & (F.col("_n_uniq") < 2)
    new_opts = F.when(F.col("_has_dup"), F.col("_uniq")).otherwise(opts)
    too_few = F.size(new_opts) < 2
    label_bad = label.isNull() | (label < 0) | (label >= F.size(opts))
    both_empty = (F.col("_text_s") == "") & (F.col("_question_s") == "")
    same = same_ignoring_case(F.col("_text_s"), F.col("_question_s"))

    reason = (F.when(other, F.lit("other_error"))
              .when(invalid_opt, F.lit("invalid_option"))
              .when(dup_opts, F.lit("duplicate_options"))
              .when(too_few, F.lit("too_few_options"))
              .when(label_bad, F.lit("label_out_of_range"))
              .when(both_empty, F.lit("text_question_empty"))
              .when(same, F.lit("text_equals_question")))
    # Label points into the de-duplicated list (the position of the chosen
    # option's lower-case form among the distinct lower-case forms).
    remapped = F.array_position(F.array_distinct("_lows"),
                                F.get(F.col("_lows"), label.cast("int"))) - 1
    x = x.withColumn("reason", reason)
    # Merged rows: repeats present, >= 2 distinct left, and no earlier rule
    # (1-2) fired.  Their options are replaced even if a later rule rejects them.
    r = F.coalesce(F.col("reason"), F.lit(""))
    deduped = F.col("_has_dup") & r.isin("", "label_out_of_range", "text_question_empty",
                                         "text_equals_question")
    x = (x.withColumn("note", F.when(deduped, F.lit(NOTE_DEDUPED)))
         .withColumn("original_options", F.when(deduped, F.col("_opts_s")))
         .withColumn("original_label", F.when(deduped, label))
         .withColumn("options", F.when(deduped, F.col("_uniq")).otherwise(opts))
         .withColumn("label", F.when(deduped & (r != "label_out_of_range"), remapped.cast("bigint"))
                     .otherwise(label)))

    x = x.withColumn("_key", F.when(F.col("reason").isNull(),
                                    _dup_key(F.col("_text_s"), F.col("_question_s"), F.col("options"))))
    return x.drop("_opts_s", "_lows", "_n_uniq", "_has_dup", "_uniq", "_text_s", "_question_s")


def classify(df: DataFrame, dataset: Sequence[str] = ("dataset",), order: str = "index", keep: Sequence[str] | None = None,
             derive: dict[str, Column] | None = None, row_id: Sequence[str] = ()) -> DataFrame:
    """Attach ``reason`` (NULL = valid) and the repaired options/label.

    Input: text, question, options, label, ``order`` (+ dataset columns).
    Rule 8: of the rows of a dataset (NULL is one) that are valid so far and
    equal, the first by ``order`` (NULL last, then by row) stays; the others
    are duplicate_sample, also where rows repeat as a whole.

    The row rules run in one scan, whose result is written once with a row
    number; rule 8 reads the narrow keys from there.  ``keep`` names the columns
    to write and return (all by default), ``derive`` further ones computed from
    the repaired row in that scan, so that consumers of lengths, fingerprints or
    labels never write a text.  Where all columns are asked for and ``row_id``
    names columns that identify a row of the input (file and row), only the keys
    are written and the text is scanned again instead.
    """
    ds = list(dataset)
    x = annotate(df)
    for name, column in (derive or {}).items():
        x = x.withColumn(name, column)
    columns = [c for c in x.columns if c != "_key"] if keep is None else [*keep, *(derive or {})]
    if keep is None and row_id:
        ids = [*ds, *row_id]
        t = numbered(x.select(*dict.fromkeys([*ids, order, "_key"])).where(F.col("_key").isNotNull()), "sample-keys")
        x = x.drop("_key")
        later = later_rows(t, [*ds, "_key"], [order], ids)
    else:
        ids = ["_rid"]
        t = numbered(x.select(*dict.fromkeys([*columns, *ds, order, "reason", "_key"])), "classified")
        x, later = t, later_rows(t.where(F.col("_key").isNotNull()), [*ds, "_key"], [order], ids)
    later = later.select(*[F.col(c).alias(f"_later{k}") for k, c in enumerate(ids)])
    x = x.join(later, [x[c].eqNullSafe(F.col(f"_later{k}")) for k, c in enumerate(ids)], "left")
    x = x.withColumn("reason", F.when(F.col(f"_later{len(ids) - 1}").isNotNull(), F.lit("duplicate_sample")).otherwise(F.col("reason")))
    return x.select(*dict.fromkeys([*columns, "reason"]))


def reject_counts(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A2: rows per reason ('VALID' for kept rows) -- partial+final hash agg."""
    return (classified.groupBy(*by, F.coalesce("reason", F.lit("VALID")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


def annotation_counts(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Kept rows that had their options merged, per dataset."""
    return (classified.groupBy(*by)
            .agg(F.count_if(F.col("note").isNotNull() & F.col("reason").isNull()).alias("deduped_kept"),
                 F.count_if(F.col("reason").isNull()).alias("kept"),
                 F.count_if(F.col("reason").isNotNull()).alias("invalid")))


def valid_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason").isNull())


# --- strict validator (P3) and mix validator on typed rows (P4) -----------

def strict_reason(df: DataFrame) -> DataFrame:
    """All four fields present; text AND question non-empty; options a
    non-empty list of non-blank strings; label in range."""
    opts = F.col("options")
    label = F.col("label")
    r = (F.when(F.col("text").isNull() | F.col("question").isNull() | opts.isNull() | label.isNull(),
                F.lit("missing_field"))
         .when((py_strip("text") == "") | (py_strip("question") == ""), F.lit("text_or_question_empty"))
         .when(F.size(opts) == 0, F.lit("options_empty"))
         .when(F.exists(opts, lambda o: o.isNull() | (py_strip(o) == "")), F.lit("option_blank"))
         .when((label < 0) | (label >= F.size(opts)), F.lit("label_out_of_range")))
    return df.withColumn("strict_reason", r)


def mix_reason_typed(df: DataFrame) -> DataFrame:
    """P4 on typed rows (text/question NULL treated as ''):
    both blank, options empty, blank option, case-insensitive repeat, label range."""
    opts = F.col("options")
    label = F.col("label")
    lows = F.transform(opts, lambda o: norm(o))
    r = (F.when(opts.isNull() | label.isNull(), F.lit("missing_field"))
         .when((py_strip(blank_to_empty("text")) == "") & (py_strip(blank_to_empty("question")) == ""),
               F.lit("text_question_empty"))
         .when(F.size(opts) == 0, F.lit("options_not_list_or_empty"))
         .when(F.exists(opts, lambda o: o.isNull() | (py_strip(o) == "")),
               F.lit("option_blank_or_not_string"))
         .when(F.size(F.array_distinct(lows)) < F.size(opts), F.lit("duplicate_options"))
         .when((label < 0) | (label >= F.size(opts)), F.lit("label_out_of_range")))
    return df.withColumn("mix_reason", r)


__all__ = ["annotate", "classify", "reject_counts", "annotation_counts", "valid_rows", "option_columns",
           "option_valid_flags", "strict_reason", "mix_reason_typed", "same_ignoring_case"]
