"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from quire.plans import registry
from tools.check import TABLES, ordered


@pytest.fixture(scope="module")
def db(request):
    from tests.conftest import SF

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


registry.load_all()
QUERIES, ORACLE = registry.QUERIES, registry.ORACLES  # those of the training-data operators have tests of their own


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    columns = sorted(df.columns)
    got = ordered(df.select(*[f"`{c}`" for c in columns]).collect())
    if name not in ORACLE:
        assert got
        return
    cursor = db.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    assert got == ordered([tuple(r[i] for i in place) for r in cursor.fetchall()])


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() > 0
