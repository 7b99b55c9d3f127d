"""The registered queries of this subpackage: one ``opN_<name>`` per operator.

Each applies its operator to its whole table and keeps the digest columns.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from mcqflow.llm import (decontam, jaccard, langid, packing, periodic, phrases, quality_mil, quality_rules, sentencepieces, sharding, sql,
                         substring, tokenids, urlfilter)


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.report(_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.report(_table(spark, sf_dir, "pages").select("page_id", "url"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(_table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(_table(spark, sf_dir, "documents"))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.report(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.report(_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(_table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.report(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_url_filter, op3_quality_rules, op4_sharding, op5_benchmark_decontamination, op6_language_id, op7_quality_classifier, op8_substring_dedup, op9_token_ids, op10_sentencepiece,
                                  op11_packing, op12_periodic_runs, op13_phrase_collocations)}
ORACLE = sql.ORACLE
