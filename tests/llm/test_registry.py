import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import digest  # noqa: E402
from lastmile.llm import registry  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_an_operator():
    assert [int(name[2:].split("_")[0]) for name in sorted(registry.queries(), key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert set(registry.queries()) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "labels", "embeddings"):
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    frame = registry.queries()[name](spark, SF)
    want = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(frame.columns) == sorted(columns)
    assert digest(frame.columns, [tuple(r) for r in frame.collect()])[0] == digest(columns, want.fetchall())[0]
