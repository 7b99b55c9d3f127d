"""Validating JSON-lines loader with per-line reject reasons (S8 + P4).

Lines are read as text and parsed as VARIANT, so that wrong JSON types
(label "1", true or 1.0; a number among the options) are told apart from
valid values instead of being coerced.  Line numbers are exact, 1-based per
file, from (file, split start, row id) and a map with a row a split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mcqflow.functions.text import norm, py_strip
from mcqflow.sources.native import place, with_positions

INT_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT")


def _vtype(path: str) -> Column:
    return F.expr(f"schema_of_variant(variant_get(_v, '{path}'))")


def _present(path: str) -> Column:
    return F.expr(f"variant_get(_v, '{path}')").isNotNull()


def read_lines(spark: SparkSession, path: str, line_numbers: bool = True) -> DataFrame:
    """(file, raw, and the 1-based line_number if asked for) of every line of
    every file under ``path``; the lines are not moved for their numbers."""
    file = F.col("_metadata.file_path").alias("file")
    if not line_numbers:
        return spark.read.text(path).select(F.col("value").alias("raw"), file)
    df = with_positions(spark.read.text(path).select(F.col("value").alias("raw"), *place()), "line_number", per_file=True)
    return df.select("raw", F.col("_file").alias("file"), (F.col("line_number") + 1).alias("line_number"))


def validate_lines(lines: DataFrame, dataset: Column | str) -> DataFrame:
    """Adds ``reason`` (NULL = valid) and the typed fields of valid lines."""
    ds = F.lit(dataset) if isinstance(dataset, str) else dataset
    x = lines.withColumn("_v", F.expr("try_parse_json(raw)"))
    is_obj = F.expr("schema_of_variant(_v)").startswith("OBJECT")
    text = F.when(_vtype("$.text") == "STRING", F.expr("variant_get(_v, '$.text', 'string')"))
    question = F.when(_vtype("$.question") == "STRING", F.expr("variant_get(_v, '$.question', 'string')"))
    opt_types = F.expr("transform(try_variant_get(_v, '$.options', 'array<variant>'), o -> schema_of_variant(o))")
    options = F.expr("try_variant_get(_v, '$.options', 'array<string>')")
    is_list = _vtype("$.options").startswith("ARRAY")
    x = (x.withColumn("_ts", py_strip(F.coalesce(text, F.lit(""))))
         .withColumn("_qs", py_strip(F.coalesce(question, F.lit(""))))
         .withColumn("_ot", opt_types).withColumn("_o", options))
    label_t = _vtype("$.label")
    label = F.expr("try_variant_get(_v, '$.label', 'bigint')")
    reason = (F.when(F.col("_v").isNull(), F.lit("json_parse_error"))
              .when(~is_obj | ~_present("$.text") | ~_present("$.question") | ~_present("$.options")
                    | ~_present("$.label"), F.lit("missing_field"))
              .when((F.col("_ts") == "") & (F.col("_qs") == ""), F.lit("text_question_empty"))
              .when(~is_list | (F.size("_ot") == 0), F.lit("options_not_list_or_empty"))
              .when(F.exists("_ot", lambda t: t != "STRING")
                    | F.exists("_o", lambda o: py_strip(o) == ""), F.lit("option_blank_or_not_string"))
              .when(F.size(F.array_distinct(F.transform("_o", lambda o: norm(o)))) < F.size("_o"),
                    F.lit("duplicate_options"))
              .when(~label_t.isin(*INT_TYPES), F.lit("label_not_int"))
              .when((label < 0) | (label >= F.size("_o")), F.lit("label_out_of_range")))
    source = F.when(_present("$.source"), F.expr("variant_get(_v, '$.source', 'string')")).otherwise(ds)
    return (x.withColumn("reason", reason)
            .withColumn("text", text).withColumn("question", question).withColumn("options", F.col("_o"))
            .withColumn("label", label).withColumn("source", source).withColumn("dataset", ds)
            .drop("_v", "_ts", "_qs", "_ot", "_o"))


def load_validated(spark: SparkSession, path: str, dataset: str, line_numbers: bool = True) -> DataFrame:
    """Every line with its verdict; valid rows carry typed fields."""
    return validate_lines(read_lines(spark, path, line_numbers), dataset)


def loader_report(validated: DataFrame) -> DataFrame:
    """Per dataset: total lines, valid, invalid."""
    return validated.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(F.col("reason").isNull()).alias("valid_samples"),
        F.count_if(F.col("reason").isNotNull()).alias("invalid_samples"))
