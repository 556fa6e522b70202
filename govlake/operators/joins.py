"""Join operators.

Broadcast policy: only tables with a fixed size bound (enum/unit tables,
a number series) get an explicit ``broadcast`` hint.  Every other lookup is
left to the planner: the static planner broadcasts below
``spark.sql.autoBroadcastJoinThreshold`` using file statistics, and AQE
converts a sort-merge join to a broadcast at run time once the shuffled
size is measured - a checked bound with the shuffle join as the way beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(left: DataFrame, right: DataFrame, on, cols: dict[str, str] | None = None,
           how: str = "left", distinct: bool = False) -> DataFrame:
    """Left equi-join pulling ``cols`` (right name -> output name) from a
    lookup.  ``on`` is a column list or a ``{left: right}`` mapping;
    ``distinct`` de-duplicates the lookup side first."""
    if isinstance(on, dict):
        pairs = list(on.items())
    else:
        pairs = [(k, k) for k in ([on] if isinstance(on, str) else on)]
    cols = cols or {c: c for c in right.columns if c not in {r for _, r in pairs}}
    r = right.select(*[F.col(rk).alias(f"_r{i}") for i, (_, rk) in enumerate(pairs)],
                     *[F.col(src).alias(dst) for src, dst in cols.items()])
    if distinct:
        r = r.distinct()
    cond = None
    for i, (lk, _) in enumerate(pairs):
        e = left[lk] == r[f"_r{i}"]
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r{i}" for i in range(len(pairs))])


def pair_within(left: DataFrame, right: DataFrame, scope: str, left_cols: dict[str, str],
                right_cols: dict[str, str]) -> DataFrame:
    """Pair each designated left row (e.g. the staging lakehouse of a
    workspace, chosen by the caller's filter) with the right rows of the same
    ``scope``; the right side is required (inner).  The output is designated
    rows x group size, so ``left`` must be the designated few per scope -
    pairing a group with itself would emit all pairs of the group."""
    l = left.select(F.col(scope).alias("_scope"), *[F.col(k).alias(v) for k, v in left_cols.items()])
    r = right.select(F.col(scope).alias("_scope"), *[F.col(k).alias(v) for k, v in right_cols.items()])
    return l.join(r, "_scope").drop("_scope")


def left_outer_distinct(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """KQL ``leftouter`` join followed by ``distinct *``."""
    return left.join(right, on, "left").distinct()


def inner_unique(left: DataFrame, right: DataFrame, on: list[str], order: list[str] | None = None,
                 reduce_on: list[str] | None = None) -> DataFrame:
    """KQL ``innerunique``: the left side is reduced to one row per key
    (``reduce_on``, default the join key; the kept row is fixed by
    ``order``, default the least remaining columns), then inner-joined.
    The reduction is a partial aggregate, so a hot key sends one row per
    partition through the shuffle."""
    keys = reduce_on or on
    rest = [c for c in left.columns if c not in keys]
    from .flatten import dedupe
    one = dedupe(left, keys, order) if rest else left.distinct()
    return one.join(right, on, "inner")


def star_join(fact: DataFrame, dims: list[tuple], use: set[str] | None = None) -> DataFrame:
    """Join a fact to its dimensions through a relationship list.

    ``dims`` holds ``(name, dim_df, fact_key, dim_key, active)``; inactive
    relationships are skipped unless named in ``use``.  Dimension columns
    are prefixed ``<name>_`` to keep names unique.
    """
    use = use or set()
    out = fact
    for name, dim, fk, dk, active in dims:
        if not active and name not in use:
            continue
        d = dim.select(*[F.col(c).alias(f"{name}_{c}") for c in dim.columns])
        out = out.join(d, out[fk] == d[f"{name}_{dk}"], "left")
    return out


def filter_through(df: DataFrame, bridge: DataFrame, far: DataFrame, df_key: str, bridge_near: str,
                   bridge_far: str, far_key: str) -> DataFrame:
    """Bidirectional filter - keep ``df`` rows linked through ``bridge``
    to a row of the (filtered) ``far`` table: two semi-joins."""
    b = bridge.join(far.select(F.col(far_key).alias(bridge_far)), bridge_far, "left_semi")
    return df.join(b.select(F.col(bridge_near).alias(df_key)), df_key, "left_semi")


def filter_by_values(df: DataFrame, col: str, values: DataFrame, values_col: str) -> DataFrame:
    """Virtual relationship - keep rows whose ``col`` is in a value set
    held by another (unrelated) table: a semi-join, not a collected list."""
    return df.join(values.select(F.col(values_col).alias(col)), col, "left_semi")


def lookup_single(left: DataFrame, right: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """LOOKUPVALUE - the value for the composite key when exactly one
    distinct value matches, otherwise null."""
    r = (right.groupBy(*keys).agg(F.count_distinct(value).alias("_n"), F.min(value).alias("_v"))
         .select(*keys, F.when(F.col("_n") == 1, F.col("_v")).alias(name)))
    return left.join(r, keys, "left")


def with_series(df: DataFrame, start: int, stop: int, name: str = "Value") -> DataFrame:
    """Every row of ``df`` repeated for each number ``start..stop``,
    built as an in-row ``explode(sequence)`` (no cross join)."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(start), F.lit(stop))))
