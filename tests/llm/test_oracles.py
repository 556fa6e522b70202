"""Queries that SQL can express, against DuckDB over the same files."""

import duckdb
import pytest
from llm_fixtures import _workers  # noqa: F401

from govlake.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    cols = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    rows = sorted(tuple(r) for r in got.select(*cols).collect())
    assert rows == sorted(want.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall())
    assert rows
