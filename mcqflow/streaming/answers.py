"""Streaming reasoning validation: JSON-lines files in, Parquet out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mcqflow.functions.answers import answer_correct, extract_answer, reasoning_problems

REASONING_ROW = "index bigint, text string, question string, options array<string>, label bigint, reasoning string"


def check_columns(df: DataFrame, letters: str = "ABCDEF") -> DataFrame:
    r = F.col("reasoning")
    return df.select("index", "label",
                     extract_answer(r, letters).alias("extracted"),
                     reasoning_problems(r, F.col("label"), letters).alias("problems")
                     ).withColumn("valid", F.size("problems") == 0).withColumn(
        "answer_correct", answer_correct(F.col("extracted"), F.col("label")))


def reasoning_check_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                           letters: str = "ABCDEF", available_now: bool = True,
                           max_files_per_trigger: int = 1000):
    """Starts a file-source stream of reasoning rows (JSON lines) that writes
    per-row verdicts as Parquet.  The checkpoint makes the sink exactly-once
    across restarts.  Returns the StreamingQuery."""
    src = (spark.readStream.schema(REASONING_ROW).option("maxFilesPerTrigger", max_files_per_trigger)
           .json(source_dir))
    w = (check_columns(src, letters).writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
