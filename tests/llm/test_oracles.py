"""The operators that have SQL, held against DuckDB over a whole small table."""

from __future__ import annotations

import duckdb
import pytest

from lodestrata.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = duck.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF).select(*rel.columns)
    assert sorted(map(tuple, got.collect())) == sorted(rel.fetchall())
