"""Filters over a relationship graph, and measure families."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from govlake.operators import context as CX

R = CX.Relationship
GRAPH = [R("fact", "item", "items", "id"), R("items", "ws", "spaces", "id"), R("spaces", "cap", "caps", "id"), R("fact", "day", "days", "id"),
         R("fact", "owner_ws", "spaces", "id", active=False)]


@pytest.fixture(scope="module")
def tables(spark):
    f = spark.createDataFrame
    return {"fact": f([(1, "a", "d1", "w2"), (2, "b", "d1", "w1"), (3, "c", "d2", "w1"), (4, None, "d1", "w1"), (5, "zz", "d1", None)], "n int, item string, day string, owner_ws string"),
            "items": f([("a", "w1", "x"), ("b", "w2", "x"), ("c", "w1", "y")], "id string, ws string, kind string"),
            "spaces": f([("w1", "c1"), ("w2", "c2"), ("w3", "c1")], "id string, cap string"), "caps": f([("c1", "F2"), ("c2", "F4")], "id string, sku string"),
            "days": f([("d1", True), ("d2", False)], "id string, work boolean")}


def n(df):
    return sorted(r[0] for r in df.select(df.columns[0]).collect())


def test_filters_travel_from_one_to_many(tables):
    got = lambda target, filters, **kw: n(CX.filtered(target, tables, filters, GRAPH, **kw))
    assert got("fact", {}) == [1, 2, 3, 4, 5]
    assert got("fact", {"caps": F.col("sku") == "F2"}) == [1, 3]
    assert got("fact", {"caps": F.col("sku") == "F2", "days": F.col("work")}) == [1]
    assert got("fact", {"caps": F.col("sku") == "F2", "items": F.col("kind") == "y", "fact": F.col("n") < 9}) == [3]
    assert got("caps", {"items": F.col("kind") == "y"}) == ["c1", "c2"]  # not against a relationship
    assert got("fact", {"caps": F.col("sku") == "none"}) == []


def test_filters_travel_both_ways_where_switched_on(tables):
    both = ["items.ws->spaces.id", "spaces.cap->caps.id"]
    got = lambda target, filters, both: n(CX.filtered(target, tables, filters, GRAPH, both=both))
    assert got("caps", {"items": F.col("id") == "b"}, both) == ["c2"]
    assert got("caps", {"fact": F.col("n") == 3}, [*both, "fact.item->items.id"]) == ["c1"]
    assert got("items", {"caps": F.col("sku") == "F2"}, both) == ["a", "c"]
    assert got("caps", {"items": F.col("id") == "b"}, both[:1]) == ["c1", "c2"]


def test_inactive_relationship_and_ambiguity(tables):
    use = ["fact.owner_ws->spaces.id"]
    only = [r for r in GRAPH if (r.many, r.one) != ("items", "spaces")]
    assert n(CX.filtered("fact", tables, {"caps": F.col("sku") == "F4"}, only, use=use)) == [1]
    with pytest.raises(ValueError, match="two ways"):
        CX.filtered("fact", tables, {"caps": F.col("sku") == "F4"}, GRAPH, use=use)
    with pytest.raises(ValueError, match="no relationship"):
        CX.filtered("fact", tables, {}, GRAPH, use=["a.b->c.d"])


def test_facts_are_reduced_by_semi_joins_alone(spark, tables, tmp_path):
    """Tables without a filter behind them aren't read; the fact is read once and nothing is joined but keys."""
    stored = {}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = CX.filtered("fact", stored, {"caps": F.col("sku") == "F2"}, GRAPH)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == plan.count("Join ") == 3 and plan.count("Relation [") == 4


def test_measure_family(spark):
    data = [("x", "p", 1, "u1", 1.1), ("x", "p", 2, None, 2.2), ("x", "q", 3, "u1", None), ("y", "q", 4, "u2", 4.4), (None, "q", 5, "u2", 5.5)]
    df = spark.createDataFrame(data, "a string, b string, n int, u string, v double")
    m = CX.Measure
    got = CX.measure_family(df, {"rows": m("count"), "odd": m("count", where=F.col("n") % 2 == 1), "users": m("distinct", "u"), "p_users": m("distinct", "u", F.col("b") == "p"),
                                 "v": m("sum", "v", decimals=1), "mean": m("avg", "n"), "top": m("max", "n", F.col("u") == "u1")}, [[], ["a"], ["a", "b"]])
    want = [("", None, None, 5, 3, 3, 2, 13.2, 3.0, 3), ("a", "x", None, 3, 2, 2, 2, 3.3, 2.0, 3), ("a", "y", None, 1, 0, 1, 0, 4.4, 4.0, None), ("a", None, None, 1, 1, 1, 0, 5.5, 5.0, None),
            ("a,b", "x", "p", 2, 1, 2, 2, 3.3, 1.5, 1), ("a,b", "x", "q", 1, 1, 1, 0, None, 3.0, 3), ("a,b", "y", "q", 1, 0, 1, 0, 4.4, 4.0, None), ("a,b", None, "q", 1, 1, 1, 0, 5.5, 5.0, None)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_measure_family_reads_once(spark, tmp_path):
    spark.range(100).select((F.col("id") % 3).alias("a"), (F.col("id") % 5).alias("b"), "id").write.parquet(f"{tmp_path}/t")
    got = CX.measure_family(spark.read.parquet(f"{tmp_path}/t"), {"rows": CX.Measure("count"), "ids": CX.Measure("distinct", "id")}, [[], ["a"], ["b"], ["a", "b"]])
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert rows(got.where("grain = 'a'"), ["rows", "ids"]) == [(33, 33), (33, 33), (34, 34)]
