"""Registration, and the queries that SQL can express against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as E
from gridzone.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


def test_all_are_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF).select(want.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)
