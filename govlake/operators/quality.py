"""Data checks the governance models run on every table: the table has
rows and each column has values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_empty(df: DataFrame) -> bool:
    """True when the table has at least one row (reads at most one row)."""
    return not df.isEmpty()


def column_profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row per column: ``(column, rows, non_null, distinct)`` from a
    single aggregation pass (partial aggregates, no per-column scan).
    ``distinct`` is approximate (HyperLogLog) unless ``exact``."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        q = F.col(f"`{c}`")
        aggs.append(F.count(q).alias(f"_nn{i}"))
        aggs.append((F.count_distinct(q) if exact else F.approx_count_distinct(q)).alias(f"_d{i}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_nn{i}").alias("non_null"),
                              F.col(f"_d{i}").alias("distinct")) for i, c in enumerate(cols)])
    return wide.select(F.col("_rows").alias("rows"), F.explode(rows).alias("p")).select(
        "p.column", "rows", "p.non_null", "p.distinct")


def empty_columns(df: DataFrame) -> DataFrame:
    """Columns without a single non-null value."""
    return column_profile(df).filter(F.col("non_null") == 0).select("column")
