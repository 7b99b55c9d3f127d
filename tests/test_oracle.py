"""Registered queries against their DuckDB oracle SQL at sf 0.001."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL, norm_rows

Q = E.queries()
O = E.oracle_sql()
# Fast representatives of every operator family; tools/oracle_check.py runs all.
NAMES = ["clean_reject_counts", "option_dedupe_remap", "mix_validate", "dataset_stats", "fingerprint_groups",
         "mix_ratio_sample", "shuffle_rank", "length_fence", "split_flags", "balance_labels", "balance_report",
         "chunk_source_counts", "source_trend_sliding", "prompt_render_analysis", "request_payload",
         "chat_template", "length_by_dataset", "hist_stacked", "extract_answer", "extract_answer_noise",
         "reasoning_problems", "accuracy_by_type", "json_response_check", "source_race", "source_balacopa",
         "loader_reject_counts", "pipeline_mix"]


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = {n for n in set(Q) - set(O) if not re.match(r"op\d+_|pipeline$", n)}
    assert rows_only == set()
    assert set(O) <= set(Q)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = Q[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(O[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert norm_rows(s_cols, s_rows) == norm_rows(d_cols, d_rows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["reason", "n"]
    assert sum(r.n for r in df.collect()) == 200
