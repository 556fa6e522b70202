"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import free, stage


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of a link between two different nodes, with the smallest node it reaches.

    Each round joins the links with the smallest neighbour of each node, so no
    component is ever held in one place, and rounds grow with the logarithm of
    a component's size.  Links with a null end are no links.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    e = stage(e, "links")
    seen = _state(e)
    while seen[0]:
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").where(F.col("y") > F.col("x")).select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        before, e = e, stage(small.where("u != v").distinct(), "links")
        free(before)
        now = _state(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    out._staged = e._staged  # for free()
    return out
