"""Cutting lineage with tables in the shared folder, and small plan helpers."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark setting: shuffle files of a write go as soon as the write has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a no-op where it is installed there)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a local session (tests, the bench) gets a
    temporary folder of its own; on a cluster that is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="govlake-llm-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return base.rstrip("/")


def new_folder(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/llm-{tag}-{uuid.uuid4().hex}"


def private(*frames: DataFrame):
    """Names for columns of one's own beside those of ``frames``: a prefix that none of their columns begins with."""
    taken = [c.lower() for df in frames for c in df.columns]
    mark = "_"
    while any(c.startswith(mark) for c in taken):
        mark += "_"
    return lambda name: mark + name


#: Lists that note the folders of tables staged while they are in use; see :func:`noted`.
_NOTES: list[list[str]] = []


@contextlib.contextmanager
def noted(paths: list[str]):
    """Adds the folder of every table that is staged meanwhile to ``paths``."""
    _NOTES.append(paths)
    try:
        yield paths
    finally:
        _NOTES.remove(paths)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Removes folders of staged tables; nobody may read them any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def free(*tables: DataFrame) -> None:
    """Removes staged tables after their last reader has ended, so that a job's tables don't pile up."""
    for df in tables:
        remove(df.sparkSession, getattr(df, "_staged", []))


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    The rows survive lost executors, later reads prune columns and know the
    table's size, and the shuffles behind the write are freed at its end.
    :func:`free` removes the table.
    """
    spark = df.sparkSession
    path = new_folder(spark, tag)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = [path]
    for paths in _NOTES:
        paths.append(path)
    return out


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file on this machine (parameter ``name`` may also be a path)."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
