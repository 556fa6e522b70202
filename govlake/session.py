"""Session helpers: a tuned builder for local runs and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "govlake", cores: str | int = "*",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE, skew-join handling and the UI off.

    On a cluster the master and memory come from spark-submit; this builder
    is for local runs, tests and the bench.
    """
    parts = shuffle_partitions or (8 if cores == "*" else max(int(cores), 1))
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("GOVLAKE_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a no-op where it is installed there)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the reliable checkpoint folder, wiring it into the SparkContext.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we use it
    as given.  Only where it is unset, a local session (tests, the bench) gets
    ``fallback``, or a temporary folder of its own; on a cluster an unset
    folder is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    target = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not target:
        if not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        target = fallback or tempfile.mkdtemp(prefix="govlake-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


#: Spark setting: shuffle files of a write go as soon as the write has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, tag: str, fallback: str | None = None, codec: str | None = None):
    """Write ``df`` as parquet under the reliable checkpoint folder and read
    it back: a lineage cut that survives executor loss (the rows live in
    the shared folder, not on executors), and - unlike RDD checkpoints -
    stays columnar, so later reads prune columns and push filters.  The
    shuffle files behind the write are freed at its end.  ``codec`` is
    parquet's compression, the session's default if None.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark, fallback).rstrip("/")
    path = f"{base}/govlake-{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        (df.write.option("compression", codec) if codec else df.write).mode("errorifexists").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.parquet(path)
    out._written = path
    return out


def discard(*tables) -> None:
    """Remove tables of :func:`materialize` that nobody will read any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(df._written)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
