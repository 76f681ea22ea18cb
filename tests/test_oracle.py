"""Every query with an oracle SQL text equals DuckDB on the small test tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from lastmile.plans import catalog  # noqa: E402

QUERIES = catalog.queries()
SQL = {name: text for name, text in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    exp_cols, exp = [d[0] for d in res.description], res.fetchall()
    assert sorted(got_cols) == sorted(exp_cols)
    assert len(got) == len(exp)
    assert digest(got_cols, got)[0] == digest(exp_cols, exp)[0]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["day", "year", "month", "city"]


def test_every_query_is_registered_with_oracle():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name,columns", [
    ("kpi_daily", ["day", "city"]), ("silver_cities", ["city"]), ("contract_values", ["contract"]),
    ("kpi_courier", ["score", "courier_id"]), ("export_kpi_courier", ["score", "courier_id"])])
def test_sorted_queries_are_sorted(spark, name, columns):
    got = [tuple((v is not None, v) for v in r) for r in QUERIES[name](spark, SF_SMALL).select(*columns).collect()]
    assert got == sorted(got) and got
