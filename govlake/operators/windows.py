"""Window, ranking and ordering operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def rank_desc(df: DataFrame, part: list[str], order: str, name: str = "rank") -> DataFrame:
    """Rank within each group by ``order`` descending; ties share a rank
    and leave gaps."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(*part).orderBy(F.col(order).desc())))


def running_total(df: DataFrame, part: list[str], order: str, value: str, name: str = "running_total") -> DataFrame:
    """Cumulative sum of ``value`` in ``order`` within each group (rows
    up to and including the current one)."""
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(value).over(w))


def running_total_grouped(df: DataFrame, part: list[str], order: str, value: str,
                          name: str = "running_total") -> DataFrame:
    """W3 for a possibly huge group: cumulative sum without one task per
    group.  Values are first summed per order value (one row each), the
    running total is taken over those sums, and the rows get their order
    value's total.  Ties in ``order`` share the total (RANGE semantics)."""
    per = df.groupBy(*part, order).agg(F.sum(value).alias("_s"))
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn(name, F.sum("_s").over(w)).drop("_s")
    return _join_null_safe(df, per, [*part, order])


def share_of_total(df: DataFrame, value: str, part: list[str] | None = None, name: str = "share") -> DataFrame:
    """Share of the total within the selection (or within ``part``).

    The total comes from an aggregate (a scalar subquery, or a grouped
    aggregate joined back), never from a window over the whole table,
    which Spark would run in a single task."""
    if not part:
        return df.withColumn(name, F.try_divide(F.col(value).cast("double"), df.select(F.sum(value)).scalar()))
    tot = df.groupBy(*part).agg(F.sum(value).alias("_tot"))
    return (_join_null_safe(df, tot, part).withColumn(name, F.try_divide(F.col(value).cast("double"), F.col("_tot")))
            .drop("_tot"))


def row_index(df: DataFrame, part: list[str], order: list, name: str = "Index") -> DataFrame:
    """1-based row number within ``part``."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(*order)))


def order_by(df: DataFrame, cols: list, desc: bool = True) -> DataFrame:
    """Order rows, nulls last (a global sort: range-partitioned, no
    single task)."""
    return df.orderBy(*[(F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last())
                        if isinstance(c, str) else c for c in cols])


def top_n(df: DataFrame, cols: list, n: int, desc: bool = True) -> DataFrame:
    """W6 top-k (Spark plans a per-partition top-k, then merges k rows each)."""
    return order_by(df, cols, desc).limit(n)


def top1_by_group(df: DataFrame, part: list[str], order: str, desc: bool = True) -> DataFrame:
    """Top-1 row per group via ``max_by``/``min_by`` of a struct - a partial
    aggregate, so a hot group never lands whole in one task."""
    rest = [c for c in df.columns if c not in part]
    pick = F.max_by if desc else F.min_by
    return (df.groupBy(*part).agg(pick(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(order)).alias("_t"))
            .select(*part, "_t.*"))


def _join_null_safe(df: DataFrame, other: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` in which null equals null; ``keys`` appear once."""
    renamed = other.withColumnsRenamed({k: f"_j_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_j_{k}"))
    return df.join(renamed, cond, how).drop(*[f"_j_{k}" for k in keys])


def prefix_counts(df: DataFrame, part: list[str], order: str, weight: str | None = None, desc: bool = False,
                  num_partitions: int | None = None, nulls: bool = False) -> DataFrame:
    """Distributed running totals over the distinct values of ``order``
    within each group - the building block for ranks, running totals and
    exact medians when one group may hold a large share of all rows.

    Output: one row per (part, value) with ``w`` (rows, or summed
    ``weight``, at that value), ``before`` (total of the values strictly
    before it in the chosen direction) and ``total`` (group total).  A null
    group is a group; null order values are left out unless ``nulls`` (first
    in ascending, last in descending order).

    1. reduce to (part, value, w) - a hash aggregate keyed by the value too;
    2. range-partition by (part, value): a hot group spans many tasks; the
       rows are written with their task's number, so every later use sees the
       same boundaries;
    3. per (part, task) subtotals - a tiny table - give each task's offset;
    4. a window per (part, task) adds the offset to the local running sum.
    Every window is bounded by one range partition, never by a whole group.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = F.coalesce(F.sum(F.col(weight)), F.lit(0)) if weight else F.count(F.lit(1))
    key = F.col(order).desc() if desc else F.col(order).asc()
    rows = df if nulls else df.filter(F.col(order).isNotNull())
    vals = rows.groupBy(*part, order).agg(w.alias("w"))
    ranged = materialize(vals.repartitionByRange(n, *[F.col(c) for c in part], key).withColumn("_pid", F.spark_partition_id()), "prefix")
    sub = ranged.groupBy(*part, "_pid").agg(F.sum("w").alias("_sub"))
    grp = Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))
    sub = sub.withColumns({
        "_off": F.coalesce(F.sum("_sub").over(grp.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "total": F.sum("_sub").over(grp)}).drop("_sub")
    local = Window.partitionBy(*part, "_pid").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    out = _join_null_safe(ranged, sub, [*part, "_pid"], "inner").withColumn(
        "before", F.col("_off") + F.coalesce(F.sum("w").over(local), F.lit(0)))
    return out.select(*part, order, "w", "before", "total")


def rank_desc_distributed(df: DataFrame, part: list[str], order: str, name: str = "rank") -> DataFrame:
    """W1 without a per-group window: rank = 1 + rows with a greater value
    in the group (ties share a rank and leave gaps; nulls come last), from
    :func:`prefix_counts`, joined back on (group, value)."""
    pc = prefix_counts(df, part, order, desc=True, nulls=True).select(*part, order, (F.col("before") + 1).cast("int").alias(name))
    return _join_null_safe(df, pc, [*part, order])


def running_total_distributed(df: DataFrame, part: list[str], order: str, value: str,
                              name: str = "running_total") -> DataFrame:
    """W3 with RANGE semantics (ties share the total, null order values come
    first) without a per-group window: the running sum of ``value`` up to and
    including each row's order value."""
    pc = prefix_counts(df, part, order, weight=value, nulls=True).select(
        *part, order, (F.col("before") + F.col("w")).alias(name))
    return _join_null_safe(df, pc, [*part, order])
