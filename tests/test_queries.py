"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from tidegauge.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return [plain(x) for x in v] if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name == "q_kmeans":
        pytest.skip("many fits; covered by test_models")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in SQL:
        assert got
        return
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    out = con.sql(SQL[name])
    assert sorted(out.columns) == columns
    want = sorted((tuple(plain(dict(zip(out.columns, r, strict=True))[c]) for c in columns) for r in out.fetchall()), key=repr)
    assert got == want
