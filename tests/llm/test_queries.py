"""Queries that SQL can express, against DuckDB on whole tables."""

import duckdb
import pytest

from registra.llm.catalogue import QUERIES, SQL

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF).toArrow()
    expected = con.execute(SQL[name]).to_arrow_table()
    names = sorted(got.schema.names)
    key = [(name, "ascending") for name in names]
    assert names == sorted(expected.schema.names)
    assert got.select(names).sort_by(key).to_pylist() == expected.select(names).sort_by(key).to_pylist()
