"""Radix selection against NumPy: wide ranges, groups, NULLs, ties, one value."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mcqflow.operators.select import passes, percentiles

PS = [0.0, 0.2, 0.25, 0.5, 0.75, 0.95, 1.0]


def _values():
    r = np.random.RandomState(5)
    return {"wide": r.randint(-2**62, 2**62, 501), "ties": r.randint(0, 4, 300), "one": np.array([7]),
            "two": np.array([-2**63, 2**63 - 1]), None: r.randint(0, 2**33, 200), "near": 10**12 + r.randint(0, 3, 99)}


def test_number_of_passes():
    assert [passes(a, b) for a, b in ((None, None), (5, 5), (0, 65535), (0, 65536), (-1, 65534), (-2**31, 2**31 - 1),
                                      (-2**63, 2**63 - 1), (10**12, 10**12 + 9))] == [1, 1, 1, 2, 1, 2, 4, 1]


@pytest.mark.parametrize("bits", [3, 16])
def test_groups_equal_numpy(spark, bits):
    vals = _values()
    rows = [(g, int(v)) for g, own in vals.items() for v in own] + [("none", None), ("two", None), (None, None)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(5)
    if bits == 3:  # many passes on a narrower range
        df = df.withColumn("v", F.shiftright("v", 44))
        vals = {g: v >> 44 for g, v in vals.items()}
    got = {r.g: r.q for r in percentiles(df, "v", PS, ["g"], bits=bits).collect()}
    assert got.pop("none") is None and set(got) == set(vals)
    for g, own in vals.items():
        s = sorted(map(int, own))
        for p, q in zip(PS, got[g]):
            pos = p * (len(s) - 1)
            a, b = s[int(np.floor(pos))], s[int(np.ceil(pos))]
            want = a if a == b else (np.ceil(pos) - pos) * a + (pos - np.floor(pos)) * b if pos % 1 else a
            assert q == pytest.approx(want, rel=1e-12, abs=1e-3), (g, p)


def test_whole_table_and_empty(spark):
    df = spark.range(1, 100001).select((F.col("id") * 7 % 100003).alias("v"))
    assert percentiles(df, "v", [0.5]).first().q == df.agg(F.percentile("v", F.array(F.lit(0.5)))).first()[0]
    assert [r.q for r in percentiles(df.limit(0), "v", PS).collect()] == [None]
    assert percentiles(df.limit(0).withColumn("g", F.lit(1)), "v", PS, ["g"]).count() == 0


def test_no_pass_gathers_a_group(spark):
    """Every window runs over counted parts (one row a range and part); no aggregate gathers values."""
    df = spark.range(1000).select((F.col("id") * 10**6).alias("v"), (F.col("id") % 3).alias("g"))
    plan = percentiles(df, "v", [0.5], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and all("_part#" in line for line in windows)
