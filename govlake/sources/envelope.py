"""Scans of JSON envelopes and of date-named snapshot folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], StructType([]))


def read_envelope(spark: SparkSession, path: str, array_fields, schema: StructType | None = None,
                  multiline: bool = True) -> DataFrame:
    """Read JSON envelopes and return one row per array element.

    ``multiline=True`` reads one envelope document per file (the API dump
    format; a file is one task).  ``multiline=False`` reads one envelope per
    line (JSON lines), which Spark splits across tasks - the format to
    prefer for large feeds.

    ``array_fields`` is an ordered list: the first field present in the data
    is exploded (``tenantSettings`` else ``value``).  An empty folder or an
    envelope without any of the fields gives an empty DataFrame.  For large
    scans pass ``schema`` - JSON has no nested schema pruning, so an explicit
    schema avoids the inference pass and reads only the declared fields.
    """
    fields = [array_fields] if isinstance(array_fields, str) else list(array_fields)
    reader = spark.read.option("multiline", "true" if multiline else "false")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        raw = reader.json(path)
    except AnalysisException as e:  # a folder without a document has no schema; a wrong path is an error
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return _empty(spark)
    present = [F.col(f) for f in fields if f in raw.columns]
    if not present:
        return _empty(spark)
    same = len({raw.schema[f].dataType.simpleString() for f in fields if f in raw.columns}) == 1
    # row by row: a document may carry the later field only
    return raw.select(F.explode(F.coalesce(*present) if same else present[0]).alias("d")).select("d.*")


def latest_leaf(spark: SparkSession, base: str) -> str | None:
    """The leaf folder reached by taking the greatest name at every level.

    Descends level by level through the file system of the path, listing one
    folder a level, so older snapshots are never listed.  None if the base is
    missing or no file lies below it.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        return None
    names: list[str] = []
    while True:
        entries = [e for e in store.listStatus(path) if not e.getPath().getName().startswith(("_", "."))]
        folders = [e.getPath().getName() for e in entries if e.isDirectory()]
        if not folders:
            return "/".join([base.rstrip("/"), *names]) if entries else None
        names.append(max(folders))
        path = jvm.org.apache.hadoop.fs.Path(path, names[-1])


def read_latest(spark: SparkSession, base: str, array_fields=None, schema: StructType | None = None,
                fmt: str = "json") -> DataFrame:
    """Read the newest snapshot under a date/time-named folder tree
    (JSON envelopes, plain JSON, or parquet with merged schemas)."""
    leaf = latest_leaf(spark, base)
    if leaf is None:
        return _empty(spark)
    if fmt == "parquet":
        return spark.read.option("mergeSchema", "true").parquet(leaf)
    if array_fields:
        return read_envelope(spark, leaf, array_fields, schema)
    reader = spark.read.option("multiline", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(leaf)
