"""Every catalogued query against its DuckDB oracle on the smallest driver tables."""
import duckdb
import pytest

import __spark_entry__ as E
from vigil.plans.catalog import QUERIES
from tools.oracle_check import TABLES, rows, close

D = "/root/testdata/sf0.001"
SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, D).toPandas()
    du = con.execute(SQL[name]).df()
    c1, r1 = rows(sp)
    c2, r2 = rows(du)
    assert c1 == c2
    assert len(r1) == len(r2)
    for x, y in zip(r1, r2):
        assert all(close(a, b) for a, b in zip(x, y)), (x, y)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "isdeathdispo" in df.columns


def test_every_query_has_an_oracle_or_is_random():
    rows_only = {"gbt_scores", "gbt_importance", "gbt_split_counts"}
    missing = set(QUERIES) - set(SQL)
    assert missing == rows_only, missing
