"""Incremental loads as Structured Streaming micro-batches.

New feed files (JSON envelopes) arrive in a landing folder; a file-source
stream picks them up and each micro-batch is merged into the gold table
with the batch merge operators (M1-M3).  The merge result is written as the
version after the last committed one, marked with its stream and epoch, so:

* a micro-batch that fails and is replayed writes the same version again
  (the half-written folder of the failed attempt is replaced);
* a stream that starts anew from a fresh checkpoint goes on after the
  versions there are;
* readers always see a complete version - the newest committed one;
* the stream's own checkpoint (offsets + commits) lives in the shared
  checkpoint folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import merge as M

VERSION_PREFIX = "v"
SUCCESS = "_SUCCESS"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def committed_versions(spark: SparkSession, base: str) -> list[int]:
    """Version numbers under ``base`` whose write committed (has _SUCCESS)."""
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION_PREFIX) and name[1:].isdigit():
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), SUCCESS)):
                out.append(int(name[1:]))
    return sorted(out)


def read_current(spark: SparkSession, base: str, schema: StructType | None = None) -> DataFrame | None:
    """The newest committed version of a versioned table (None if empty)."""
    vs = committed_versions(spark, base)
    if not vs:
        return None
    return spark.read.parquet(f"{base.rstrip('/')}/{VERSION_PREFIX}{vs[-1]:08d}")


def _write_version(df: DataFrame, base: str, version: int, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{base.rstrip('/')}/{VERSION_PREFIX}{version:08d}")


def _epoch_mark(spark: SparkSession, base: str, version: int, mark: str, put: bool = False) -> bool:
    """Whether a version carries the mark of a stream's epoch (an empty file
    that readers skip); ``put`` adds it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{VERSION_PREFIX}{version:08d}/{mark}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.createNewFile(path) if put else fs.exists(path)


def merge_batch_fn(base: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame],
                   partition_by: list[str] | None = None, stream: str = ""):
    """A ``foreachBatch`` function applying ``merge(current, batch)``; with
    ``partition_by`` each version is written partitioned (e.g. by date, so
    readers' date filters prune folders).

    A new epoch's version follows the last committed one, whatever number the
    stream gives it, so a stream that starts anew from a fresh checkpoint goes
    on after the versions there are.  A version is marked with the stream (its
    checkpoint folder) and epoch: an epoch that is run again rewrites its own
    version from the one before it."""
    tag = hashlib.sha256(stream.encode()).hexdigest()[:16]

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        mark = f"_EPOCH_{tag}_{epoch_id}"
        done = committed_versions(spark, base)
        version = done[-1] + 1 if done else 1
        if done and _epoch_mark(spark, base, done[-1], mark):
            version = done[-1]
        prior = [v for v in done if v < version]
        current = (spark.read.parquet(f"{base.rstrip('/')}/{VERSION_PREFIX}{prior[-1]:08d}") if prior else None)
        if current is not None and partition_by:
            # partition values come back type-inferred: restore the batch's types
            types = {f.name: f.dataType for f in batch.schema.fields}
            current = current.select(*[F.col(c).cast(types[c]).alias(c) if c in partition_by and c in types else F.col(c)
                                       for c in current.columns])
        _write_version(merge(current, batch), base, version, partition_by)
        _epoch_mark(spark, base, version, mark, put=True)
    return run


def upsert_stream(spark: SparkSession, landing: str, schema: StructType, array_field: str, base: str,
                  keys: list[str], checkpoint: str, soft_delete: bool = False, now=None,
                  max_files_per_trigger: int = 1) -> StreamingQuery:
    """Stream envelope files from ``landing`` and upsert each batch into the
    versioned table at ``base`` (soft-delete semantics when every file is a
    full snapshot).  Returns the started query (``availableNow`` trigger:
    processes what is there, then stops)."""
    raw = (spark.readStream.schema(schema).option("multiline", "true")
           .option("maxFilesPerTrigger", max_files_per_trigger).json(landing))
    rows = raw.select(F.explode(F.col(array_field)).alias("d")).select("d.*")

    def merge(current: DataFrame | None, batch: DataFrame) -> DataFrame:
        src = batch
        if current is None:
            return (M.upsert_soft_delete(src.limit(0), src, keys, now) if soft_delete else src)
        return M.upsert_soft_delete(current, src, keys, now) if soft_delete else M.upsert(current, src, keys)

    return (rows.writeStream.foreachBatch(merge_batch_fn(base, merge, stream=checkpoint))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def replace_since_stream(spark: SparkSession, landing: str, schema: StructType, array_field: str, base: str,
                         date_col: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None,
                         partition_by_date: bool = False) -> StreamingQuery:
    """Stream activity envelopes and apply the high-water-mark replace (M1)
    per micro-batch; ``prepare`` turns raw records into table rows (e.g. T1).
    ``partition_by_date`` writes each version partitioned by ``date_col``."""
    raw = spark.readStream.schema(schema).option("multiline", "true").option("maxFilesPerTrigger", 1).json(landing)
    rows = raw.select(F.explode(F.col(array_field)).alias("d")).select("d.*")
    if prepare is not None:
        rows = prepare(rows)

    def merge(current: DataFrame | None, batch: DataFrame) -> DataFrame:
        return batch if current is None else M.replace_since(current, batch, date_col)

    return (rows.writeStream.foreachBatch(merge_batch_fn(base, merge, [date_col] if partition_by_date else None, checkpoint))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def versioned_stream(spark: SparkSession, landing: str, schema: StructType, array_field: str,
                     step: Callable[[DataFrame, tuple[str, int]], int], checkpoint: str,
                     prepare: Callable[[DataFrame], DataFrame] | None = None, max_files_per_trigger: int = 1) -> StreamingQuery:
    """Stream envelope files into a table of :mod:`govlake.operators.versions`, which writes only what a batch touches.

    ``step(batch, mark)`` commits one batch, e.g. ``lambda b, m: V.upsert(table, b, mark=m)``.  The mark (stream and
    epoch) goes into the version, so an epoch that is run again after its commit changes nothing."""
    raw = (spark.readStream.schema(schema).option("multiline", "true")
           .option("maxFilesPerTrigger", max_files_per_trigger).json(landing))
    rows = raw.select(F.explode(F.col(array_field)).alias("d")).select("d.*")
    rows = rows if prepare is None else prepare(rows)
    tag = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def run(batch: DataFrame, epoch: int) -> None:
        step(batch, (tag, epoch))

    return rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
