"""Every registered query against its DuckDB oracle SQL (small scale factor)."""

import math

import duckdb
import pytest

from conftest import SF_SMALL
from govlake.plans import REGISTRY
from govlake.plans.standins import TABLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_query_matches_oracle(spark, duck, name):
    q = REGISTRY[name]
    sdf = q.fn(spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = duck.execute(q.sql)
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want


def test_every_query_has_ops_and_doc():
    for q in REGISTRY.values():
        assert q.ops, q.name
        assert q.doc, q.name


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
