import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from mcqflow.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8, app="mcqflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def norm_rows(cols, rows):
    import math

    def n(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        if isinstance(v, (list, tuple)):
            return tuple(n(x) for x in v)
        if hasattr(v, "tolist"):
            return n(v.tolist())
        return v
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=repr)
