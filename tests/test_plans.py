"""Plan checks: no Python in the JVM operators; no whole-table window."""

import __spark_entry__ as E
from conftest import SF_SMALL

PY_ALLOWED = {"generate_reasoning", "generation_status_counts", "generate_json", "analysis_run",
              "retry_selection", "generate_resume"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_outside_model_calls(spark):
    q = E.queries()
    for name in ("clean_reject_counts", "pipeline_mix", "extract_answer", "balance_labels", "length_by_dataset"):
        p = _plan(q[name](spark, SF_SMALL))
        assert "PythonUDF" not in p and "MapInPandas" not in p and "ArrowEvalPython" not in p, name


def test_rank_window_is_partitioned(spark):
    df = E.queries()["shuffle_rank"](spark, SF_SMALL)
    p = _plan(df)
    # the row-level window is partitioned by the hash bucket, never a single partition
    assert "Window [row_number()" in p
    for line in p.splitlines():
        if "Window [row_number()" in line:
            assert "_bk" in line


def test_scan_prunes_columns(spark):
    df = E.queries()["chat_template"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint,role:string,text:string>" in p
    from mcqflow.sources.fixtures import load_mcq
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>" in _plan(load_mcq(spark, SF_SMALL))
    assert "ReadSchema: struct<source:string,reason:string,_rid:bigint>" in _plan(E.queries()["source_dist"](spark, SF_SMALL))


def test_single_partition_exchanges_only_over_aggregates(spark):
    """Every Exchange SinglePartition must sit on an aggregate (or on a table
    of one row per group), never on row-level data."""
    q = E.queries()
    for name in ("split_flags", "pipeline_mix", "mix_ratio_sample", "stratified_sample", "source_trend_sliding",
                 "length_fence", "batch_ids", "validation_stats"):
        lines = _plan(q[name](spark, SF_SMALL)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "Aggregate" in lines[i + 1], (name, lines[i + 1])
        assert "CartesianProduct" not in "\n".join(lines) and "BroadcastNestedLoopJoin" not in "\n".join(lines)
