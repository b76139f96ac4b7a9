"""Every query of the catalog against its SQL on the smallest tables; the others must at least run."""

import glob
import math
import os

import duckdb
import pytest

from newsloom.plans import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.5f}".rstrip("0").rstrip(".")
    return None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, con):
    df = QUERIES[name](spark, sf)
    rows, cols = df.collect(), sorted(df.columns)
    if name not in SQL:
        assert rows
        return
    r = con.sql(SQL[name])
    assert sorted(r.columns) == cols
    at = [list(r.columns).index(c) for c in cols]
    assert sorted(repr([norm(x[c]) for c in cols]) for x in rows) == sorted(repr([norm(x[i]) for i in at]) for x in r.fetchall())


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)


def test_no_cartesian_product_for_redundancy(spark, sf):
    plan = QUERIES["t13_redundancy"](spark, sf)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pruned_scan(spark, sf):
    plan = QUERIES["a2_having_min2"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "raw_text" not in plan and "embedding" not in plan
