"""Table writes with schema evolution (S6) and schema enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> None:
    """Write parquet with append/overwrite.

    Additive schema evolution needs no rewrite: parquet files with more
    columns sit next to older ones and :func:`read_table` merges the schemas.
    ``partition_by`` (e.g. a date) lets later reads prune whole folders.
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written by :func:`write_table`, merging evolved schemas."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def align(df: DataFrame, columns: list[str]) -> DataFrame:
    """Project to ``columns``; absent ones are null."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).alias(c) for c in columns])


def ensure_columns(df: DataFrame, defs: DataFrame, table: str,
                   table_col: str = "Table_Name", column_col: str = "Column_Name",
                   type_col: str = "Data_Type") -> DataFrame:
    """Add every column declared for ``table`` in ``defs`` that ``df`` lacks,
    as a typed null.  Declared types containing ``struct`` are skipped.

    ``defs`` is the small definition table; only the rows of one table (its
    column list, bounded by the table width) reach the driver.
    """
    rows = (defs.filter(F.col(table_col) == table)
            .select(column_col, type_col).distinct().collect())
    have = {c.lower() for c in df.columns}
    out = df
    for r in sorted(rows, key=lambda r: r[0]):
        name, dtype = r[0], (r[1] or "string")
        if "struct" in dtype.lower() or name.lower() in have:
            continue
        out = out.withColumn(name, F.lit(None).cast(dtype))
        have.add(name.lower())
    return out
