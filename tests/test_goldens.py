"""Golden numbers from FIXTURES.md (computed independently in plain Python)."""

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from mcqflow.functions.answers import answer_correct, extract_answer, has_conclusion, has_step_marker, step_count
from mcqflow.operators.sample import fence_stats, outlier_filter, ratio_mix, split_flags, with_total_length
from mcqflow.plans.q_clean import valid
from mcqflow.sources.fixtures import group_config, load_mcq, with_reasoning


def test_fence_split_and_draw_sf0001(spark):
    v = with_total_length(valid(spark, SF_SMALL))
    f = fence_stats(v).collect()[0]
    assert (f.q1, f.q3, f.upper) == (967.5, 2839.0, 5646.25)
    kept = outlier_filter(v)
    assert kept.count() == 167
    s = split_flags(kept).agg(F.count_if("is_eval").alias("e"), F.count_if("is_full").alias("f"),
                              F.count_if("is_peft").alias("p"),
                              F.count_if(~F.col("is_eval") & ~F.col("is_full")).alias("u")).collect()[0]
    assert (s.e, s.f, s.p, s.u) == (16, 150, 75, 1)
    d = ratio_mix(valid(spark, SF_SMALL), group_config(spark), 120)
    got = {r.grp: r["count"] for r in d.groupBy("grp").count().collect()}
    assert [got[f"g{i}"] for i in range(7)] == [12, 21, 27, 18, 18, 6, 6]


def test_reasoning_goldens_sf001(spark):
    r = with_reasoning(load_mcq(spark, SF_MID)).where("label between 0 and 4")  # the rows FIXTURES.md counts
    assert r.count() == 971
    x = r.select(extract_answer("reasoning", "ABCDEF").alias("x"), "label", "reasoning")
    hist = {row.x: row["count"] for row in x.groupBy("x").count().collect()}
    assert hist[""] == 242 and hist["E"] == 1
    assert x.where(answer_correct(F.col("x"), F.col("label"))).count() == 595
    assert r.where(answer_correct(extract_answer("reasoning"), F.col("label"))).count() == 594
    assert r.where(has_step_marker(F.col("reasoning"))).count() == 324
    assert r.where(has_conclusion(F.col("reasoning"))).count() == 486
    assert r.agg(F.sum(step_count(F.col("reasoning")))).collect()[0][0] == 406
