"""A training-data pipeline over ``documents`` from the numbered operators.

Stages, in order: quality classifier, n-gram Jaccard join, substring dedup,
benchmark decontamination, SentencePiece encoding and decoding.  Each takes
(spark, docs, sf_dir); its result is written as Parquet in the shared folder
and read again as the next stage's documents.  All but the last return the
columns of documents; whatever other columns the table has travel along.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mcqflow.llm import decontam, jaccard, quality_mil, sentencepieces, substring
from mcqflow.llm.queries import vocabulary
from mcqflow.session import materialize

ORACLE_SQL = None  # a fitted model and string alignment: tested against brute force instead


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and all columns as one struct, so no operator's column clashes with them."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("__row"))


def _unpacked(df: DataFrame, columns: list[str], text_changed: bool = False) -> DataFrame:
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")} if text_changed else {}
    return df.select(*[new.get(c, F.col(f"__row.{c}")).alias(c) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    params = quality_mil.train(docs, _table(spark, sf_dir, "labels"))
    return _unpacked(quality_mil.classify(_packed(docs), params).where("predicted = 1"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each linked group."""
    return _unpacked(jaccard.keep_one(_packed(docs)), docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that start earlier elsewhere; n_chars follows the text."""
    return _unpacked(substring.dedup_substrings(_packed(docs)), docs.columns, text_changed=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return _unpacked(decontam.decontaminate(_packed(docs), _table(spark, sf_dir, "benchmark")), docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the text, their number, and whether they decode to the text."""
    return sentencepieces.encode_decode(docs.select("doc_id", "text"), vocabulary("piece_bpe_32k.model"),
                                        outputs=("ids", "n_ids", "round_trip")).drop("text")


STAGES = [("quality_classifier", quality), ("ngram_jaccard_join", near_duplicates), ("substring_dedup", substring_dedup),
          ("benchmark_decontamination", decontamination), ("sentencepiece", sentencepiece)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
