"""Spark session settings shared by every job, and the shared scratch root.

The engine never picks a machine-local folder on its own: intermediate tables
and stream checkpoints live under the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (unit tests, a
laptop) do we create one under the system temp dir.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on (see SURVEY D1, D2): UTC session clock, ANSI
# semantics on (so ``try_*`` functions are used where the reference relied on
# nulls), directory values always strings, AQE with skew-join splitting.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from plan-time estimates (derived tables have no proven
    # size); AQE still turns a join into a broadcast when the measured
    # shuffle output of one side is below 10 MB.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10485760",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Batches to Python tasks by rows and bytes, so that a worker's memory
    # does not follow the length of the texts.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    # A source of many folders is listed by as many tasks as a cluster has cores
    # some times over, not by one per folder: a task costs more than a listing.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (driver-owned)."""
    for k, v in SESSION_CONF.items():
        if spark.conf.isModifiable(k):  # a static setting of a shared session stays
            spark.conf.set(k, v)
    return spark


def get_session(app: str = "stridelake", master: str | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false"))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and stream state.

    Read from ``spark.checkpoint.dir``. Only a local session, whose driver
    and executors are one process, gets a private folder when it is unset; it
    goes when the process ends. On a cluster an unset folder is an error: the
    executors would not see what the driver or another executor wrote.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="stridelake-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}stridelake/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through Hadoop's FileSystem, so a path without a
    scheme resolves against the cluster's default filesystem (not the
    driver's local disk)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The files and folders that a Hadoop glob pattern names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [x.getPath().toString() for x in (fs.globStatus(p) or [])]


def full_uri(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as Hadoop resolves it: Python tasks
    that open it themselves then reach the same store, not a local disk."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = fs.makeQualified(p).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and \
        not uri.startswith("file://") else uri


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder within one Hadoop filesystem."""
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"can't rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there, through Hadoop's FileSystem."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut(df, name: str = "cut"):
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and continue from the written copy: later uses read it instead of
    recomputing the plan, and a lost executor does not send the job back to
    the source. (Computed once; an un-persisted ``Dataset.checkpoint`` runs
    the plan twice.)"""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# Explicit broadcasts are only made of tables whose exact row count is known
# (counted on a materialised copy) and below this bound; beyond it the plan
# keeps its shuffle join.
BROADCAST_MAX_ROWS = 1_000_000


def bounded(df, upper_rows: int, max_rows: int = BROADCAST_MAX_ROWS):
    """``broadcast(df)`` when ``upper_rows`` (a proven upper bound of its
    row count) is within ``max_rows``; ``df`` unchanged otherwise."""
    from pyspark.sql import functions as F
    return F.broadcast(df) if upper_rows <= max_rows else df


def per_key(df, name: str = "per-key"):
    """A per-key aggregate as the small side of a join: written once, then
    broadcast if its counted rows allow. Otherwise both sides of the join have
    a shuffle of their own, which AQE can split where a key is hot (it can't
    where an aggregate stands directly under the join)."""
    df = cut(df, name)
    return bounded(df, df.count())


class computed_once:
    """Keep ``df`` (memory, spilling to disk) only while a block of work
    that reads it several times runs, typically up to a lineage cut:
    ``with computed_once(df) as d: out = cut(f(d))``. Lost blocks are
    recomputed from lineage; the cache is released on exit."""

    def __init__(self, df):
        from pyspark import StorageLevel
        self.df = df.persist(StorageLevel.MEMORY_AND_DISK)

    def __enter__(self):
        return self.df

    def __exit__(self, *exc):
        self.df.unpersist()
        return False
