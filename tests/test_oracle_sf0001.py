"""Every key with oracle SQL matches DuckDB on the smallest fixture, by a
plan without Cartesian products."""

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.sources.tables import TABLES, table_path
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return c


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    res = con.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)
