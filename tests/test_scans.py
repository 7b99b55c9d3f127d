"""What queries read and write on the way: text scans counted, no texts in intermediate tables."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as E
from conftest import SF_SMALL
from mcqflow.operators.clean import classify
from mcqflow.operators.dedup import first_wins


@pytest.fixture
def written(monkeypatch):
    """(plan, columns) of every Parquet table that a query writes."""
    out, parquet = [], DataFrameWriter.parquet

    def spy(self, path, *a, **kw):
        out.append((self._df._jdf.queryExecution().executedPlan().toString(), self._df.columns))
        return parquet(self, path, *a, **kw)
    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    return out


def text_scans(plans):
    return sum("FileScan" in line and "documents.parquet" in line and ",text:string" in line.split("ReadSchema")[-1]
               for p in plans for line in p.splitlines())


@pytest.mark.parametrize("name, scans", [("clean_reject_counts", 1), ("pipeline_clean", 1), ("length_by_dataset", 1), ("balance_report", 1),
                                         ("clean_valid_rows", 2), ("fingerprint_dedupe", 2), ("pipeline_mix", 2)])
def test_texts_are_scanned_once(spark, written, name, scans):
    """One scan gives all verdicts (the twins of the mix are a second reading of the
    same table); rows returned with their text are scanned again, not written."""
    df = E.queries()[name](spark, SF_SMALL)
    assert text_scans([p for p, _ in written] + [df._jdf.queryExecution().executedPlan().toString()]) == scans


NARROW = ["clean_reject_counts", "clean_valid_rows", "option_dedupe_remap", "clean_annotation_counts", "source_value_counts", "pipeline_clean",
          "dataset_stats", "dataset_optcount_hist", "length_quintiles", "fingerprint_dedupe", "duplicate_stats", "fingerprint_groups",
          "incremental_dedupe", "mix_ratio_sample", "mix_group_targets", "stratified_sample", "shuffle_rank", "batch_ids", "length_fence",
          "outlier_filter", "outliers", "outlier_refill", "selection_summary", "split_flags", "pipeline_mix", "balance_labels",
          "balance_report", "label_distribution", "chunk_source_counts", "length_overall", "box_stats", "prompt_token_length"]


@pytest.mark.parametrize("name", NARROW)
def test_no_text_in_tables_between(spark, written, name):
    E.queries()[name](spark, SF_SMALL)
    assert not [c for _, columns in written for c in columns if c in ("text", "question", "raw", "prompt")]


def test_draw_ranks_one_bucket_only(spark):
    plan = E.queries()["mix_ratio_sample"](spark, SF_SMALL)
    from mcqflow.operators.sample import draw_per_group
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("g"))
    d = draw_per_group(df, F.lit(50), ["id"], ["g"], max_keys=3)
    logical = d._jdf.queryExecution().optimizedPlan().toString()
    window = logical.index("Window [row_number()")
    # only buckets that the target cuts reach the ranking: the optimizer filters the offsets before they are joined
    assert re.search(r"Filter .*< 50.*> 50", logical[window:])
    assert {r.g: r["count"] for r in d.groupBy("g").count().collect()} == {0: 50, 1: 50, 2: 50}
    assert draw_per_group(df, F.lit(0), ["id"], ["g"], max_keys=3).count() == 0
    assert draw_per_group(df, F.lit(400), ["id"], ["g"], max_keys=3).count() == 1000 and plan.count() > 0


def _rows(spark, rows):
    return spark.createDataFrame(rows, "dataset string, index long, text string, question string, options array<string>, label long")


@pytest.mark.parametrize("keep", [None, ["dataset", "index"]])
def test_one_of_equal_rows_stays(spark, keep):
    """Rows that repeat as a whole, NULL datasets and NULL positions."""
    o = ["a", "b"]
    rows = [("d", 1, "t", "q", o, 0)] * 3 + [(None, 1, "t", "q", o, 0)] * 2 + [(None, None, "u", "q", o, 0)] * 2 + [(None, 5, "u", "q", o, 0)] + \
           [("d", 9, "v", "q", o, 7)] * 2
    got = classify(_rows(spark, rows).repartition(4), keep=keep).collect()
    assert len(got) == len(rows)
    left = sorted(((r.dataset, r["index"]) for r in got if r.reason is None), key=str)
    assert left == [("d", 1), (None, 1), (None, 5)]
    assert sum(r.reason == "duplicate_sample" for r in got) == 5 and sum(r.reason == "label_out_of_range" for r in got) == 2


def test_classify_by_row_id_equals_written(spark):
    from mcqflow.sources.fixtures import ROW_ID, load_mcq
    twice = load_mcq(spark, SF_SMALL, row_id=True).unionByName(load_mcq(spark, SF_SMALL, row_id=True).withColumn("_row", F.col("_row") + 10**6))
    a = classify(twice, row_id=ROW_ID).groupBy("index", "reason").count()
    b = classify(twice, keep=["index"]).groupBy("index", "reason").count()
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_first_wins_on_null_keys_and_repeats(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (None, 1), ("a", None), ("a", 3), ("a", 3)], "k string, o long")
    got = sorted(((r.k, r.o, r.is_first) for r in first_wins(df, "k", ["o"]).collect()), key=str)
    assert got == sorted([(None, 1, True), (None, 1, False), (None, 2, False), ("a", 3, True), ("a", 3, False), ("a", None, False)], key=str)
