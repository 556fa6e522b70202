"""Filters that travel over declared relationships (J6, J7), and measure families in one scan."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Relationship:
    """``many.many_key`` refers to ``one.one_key``.  A filter travels from the one side to the many side, and back
    too where ``both``; an inactive relationship only where it is switched on."""
    many: str
    many_key: str
    one: str
    one_key: str
    both: bool = False
    active: bool = True

    @property
    def ends(self) -> str:
        return f"{self.many}.{self.many_key}->{self.one}.{self.one_key}"


def in_force(relationships: list[Relationship], use: Iterable[str] = (), both: Iterable[str] = ()) -> list[Relationship]:
    """The relationships of one measure: ``use`` (by :attr:`Relationship.ends`) switches inactive ones on, which
    switches off the active one between the same two tables; ``both`` lets filters travel both ways."""
    use, both = set(use), set(both)
    unknown = (use | both) - {r.ends for r in relationships}
    if unknown:
        raise ValueError(f"no relationship {sorted(unknown)}")
    on = {(r.many, r.one) for r in relationships if r.ends in use}
    return [replace(r, both=r.both or r.ends in both, active=True) for r in relationships
            if r.ends in use or (r.active and (r.many, r.one) not in on)]


def _ways(target: str, relationships: list[Relationship]) -> list[tuple[str, str, str, Relationship]]:
    """(neighbour, its key, the target's key, relationship) for each way by which a filter can reach ``target``."""
    out = []
    for r in relationships:
        if r.many == target:
            out.append((r.one, r.one_key, r.many_key, r))
        if r.one == target and r.both:
            out.append((r.many, r.many_key, r.one_key, r))
    return out


def filtered(target: str, tables: dict[str, DataFrame], filters: dict[str, Column], relationships: list[Relationship],
             use: Iterable[str] = (), both: Iterable[str] = ()) -> DataFrame:
    """The rows of ``target`` that remain under ``filters`` (a condition a table), wherever these lie in the graph.

    A semi-join programme: from the farthest filtered table on, each table is
    reduced by its own filter and by the keys that its reduced neighbours keep,
    and hands on the distinct keys of what is left.  Only tables on a way from a
    filter to the target are read, each for the keys it hands on, so a fact is
    reduced before any join.  Two ways from one filter to the target are refused
    as ambiguous.
    """
    graph = in_force(relationships, use, both)

    def reduce(table: str, came: Relationship | None, path: tuple[str, ...]) -> tuple[DataFrame, set[str]]:
        rows, seen = tables[table], set()
        if table in filters:
            rows, seen = rows.where(filters[table]), {table}
        for neighbour, far, near, r in _ways(table, graph):
            if r is came:
                continue
            if neighbour in path:
                continue
            left, found = reduce(neighbour, r, (*path, table))
            if not found:
                continue
            if found & seen:
                raise ValueError(f"filters on {sorted(found & seen)} reach {table} by two ways")
            seen |= found
            keys = left.select(F.col(far).alias("_key")).where("_key IS NOT NULL").distinct()
            rows = rows.join(keys, rows[near] == keys["_key"], "left_semi")
        return rows, seen

    return reduce(target, None, ())[0]


# ---------------------------------------------------------------- measures
@dataclass(frozen=True)
class Measure:
    """``count`` of rows, ``sum``, ``min``, ``max``, ``avg`` or ``distinct`` (a missing value counts as one) of
    ``value``, of the rows where ``where`` holds.  Sums of ``decimals`` places are exact in any order."""
    kind: str
    value: str | None = None
    where: Column | None = None
    decimals: int | None = None


def measure_family(df: DataFrame, measures: dict[str, Measure], grains: list[list[str]]) -> DataFrame:
    """All measures at all grains, from one scan: a row a group of each grain, with ``grain`` (its columns, joined by
    commas) and null for columns that the grain leaves out.

    Rows are first aggregated by the finest key: all grains' columns and the
    values counted distinctly.  Only these groups are expanded over the grains,
    so the expansion doesn't multiply rows.  A condition that isn't true is false.
    """
    keys = list(dict.fromkeys(c for g in grains for c in g))
    kept, first, then = {}, {}, {}
    for name, m in measures.items():
        holds = F.lit(True) if m.where is None else F.coalesce(m.where, F.lit(False))
        value = None if m.value is None else F.col(m.value)
        if m.kind == "distinct":
            kept |= {f"d__{name}": F.when(holds, value), f"h__{name}": holds}
            then[name] = (F.count_distinct(f"d__{name}") + F.coalesce(F.max(F.when(F.col(f"h__{name}") & F.col(f"d__{name}").isNull(), 1)), F.lit(0))).cast("long")
        elif m.kind == "count":
            first[name] = F.count(F.when(holds, 1))
            then[name] = F.sum(name).cast("long")
        elif m.kind in ("min", "max"):
            agg = getattr(F, m.kind)
            first[name], then[name] = agg(F.when(holds, value)), agg(name)
        else:
            exact = value if m.decimals is None else value.cast(f"decimal(38,{m.decimals})")
            first[name] = F.sum(F.when(holds, exact))
            total = F.sum(name) if m.decimals is None else F.sum(name).cast("double")
            then[name] = total
            if m.kind == "avg":
                first[f"n__{name}"] = F.count(F.when(holds, value))
                n = F.sum(f"n__{name}")
                then[name] = F.when(n > 0, total / n)
    fine = df.withColumns(kept).groupBy(*keys, *kept).agg(*[a.alias(n) for n, a in first.items()] or [F.lit(1).alias("_")])
    sets = [[F.col(c) for c in g] for g in grains]
    out = fine.groupingSets(sets, *keys).agg(*[a.alias(n) for n, a in then.items()], F.grouping_id(*keys).alias("_id") if keys else F.lit(0).alias("_id"))
    named = F.lit(None).cast("string")
    for g in grains:
        mark = sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in g)
        named = F.when(F.col("_id") == mark, F.lit(",".join(g))).otherwise(named)
    return out.select(named.alias("grain"), *keys, *measures)
