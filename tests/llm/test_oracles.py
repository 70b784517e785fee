"""The queries that SQL can express, against DuckDB."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from contrail.llm import queries

KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_oracle(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df, told = queries.queries()[name](spark, sf), con.sql(queries.oracle_sql()[name])
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema} == dict(zip(told.columns, map(str, told.types), strict=True))
    assert Counter(map(tuple, df.collect())) == Counter(tuple(r[told.columns.index(c)] for c in df.columns) for r in told.fetchall())
