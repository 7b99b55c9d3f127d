"""Writers: datasets (JSON lines + Parquet), reject logs, reports."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from mcqflow.schema import MCQ_COLUMNS, REASONS


def save_dataset(df: DataFrame, path: str, formats: Sequence[str] = ("json", "parquet"),
                 partition_by: Sequence[str] = ()) -> None:
    """K1: ``path``/data.parquet and ``path``/json.  ``df`` is evaluated once: the
    first format is written from it, the others from what was written."""
    base = path.rstrip("/")
    first = "parquet" if "parquet" in formats else formats[0]
    for fmt in [first, *(f for f in formats if f != first)]:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        if fmt == "json":
            w = w.option("ignoreNullFields", "false")  # a NULL field stays in its line
        to = f"{base}/data.parquet" if fmt == "parquet" else f"{base}/{fmt}"
        w.format(fmt).save(to)
        if fmt == first == "parquet":
            df = df.sparkSession.read.parquet(to)


def save_mixed(df: DataFrame, path: str, position: str = "pos") -> None:
    """K2: the six canonical fields with ``index`` = output position, files and
    lines in that order."""
    out = df.withColumn("index", F.col(position).cast("bigint")).select(*MCQ_COLUMNS)
    out = out.repartitionByRange("index").sortWithinPartitions("index")
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def save_rejects(classified: DataFrame, path: str, by: Sequence[str] = ("dataset",)) -> tuple[DataFrame, dict[str, int]]:
    """K4: rejected rows partitioned by dataset and reason, in one scan that also
    counts them: returns the written rows and the rows by reason (A2)."""
    rej = classified.where(F.col("reason").isNotNull())
    seen = Observation()
    counted = rej.observe(seen, *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS])
    counted.write.mode("overwrite").partitionBy(*by, "reason").json(path)
    counts = seen.get
    return classified.sparkSession.read.json(path), {r: n for r, n in counts.items() if n}


def save_by_status(df: DataFrame, path: str, status: str = "status") -> None:
    """K5: one folder per status (ok / failed / manual_review)."""
    df.write.mode("overwrite").partitionBy(status).json(path)


def save_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """K6: a report table (small) as JSON or Parquet."""
    df.write.mode("overwrite").format(fmt).save(path)


def save_balanced(df: DataFrame, directory: str, name: str) -> str:
    """K3: the balanced set as JSON lines under ``balanced_<name>``."""
    path = f"{directory.rstrip('/')}/balanced_{name}"
    df.select(*[c for c in MCQ_COLUMNS if c in df.columns]).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path
