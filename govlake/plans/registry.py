"""Query registry: each registered query has a Spark builder and, where the
semantics are expressible in SQL, an oracle SQL text for DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...] = ()
    headline: bool = False
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, ops: str, sql: str | None = None, headline: bool = False):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"a query named {name} is registered already")
        REGISTRY[name] = Query(name, fn, sql, tuple(o.strip() for o in ops.split(",") if o.strip()),
                               headline, (fn.__doc__ or "").strip())
        return fn
    return deco


def rnd(c, d: int) -> Column:
    """Round half up by ``floor(x * 10^d + 0.5) / 10^d`` - the same IEEE steps
    in Spark and in the SQL oracle, so equal inputs give equal outputs."""
    c = F.col(c) if isinstance(c, str) else c
    q = float(10 ** d)  # from 2**53 on doubles have no such places (and floor() would end at 2**63)
    return F.when(F.abs(c) * q < float(2 ** 53), F.floor(c * q + 0.5) / q).otherwise(c)


def rnd_sql(expr: str, d: int) -> str:
    return f"(floor(({expr}) * {float(10 ** d)!r} + 0.5) / {float(10 ** d)!r})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
