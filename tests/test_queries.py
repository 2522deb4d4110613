"""Every registered query against DuckDB on the smallest tables, and the shape of its plan."""

import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from dimflow.queries import all_queries, all_sql  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
    cols = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    res = con.execute(SQL[name])
    names = [x[0] for x in res.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in res.fetchall())
