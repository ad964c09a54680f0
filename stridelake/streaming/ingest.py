"""Structured Streaming variants (ST-1 .. ST-3).

``ingest_files``: file-level, exactly-once ingest of new source files into a
Parquet table (checkpointed file source + sink). Unlike the trial-level
batch step, a late file of an already loaded trial is picked up.
``rate_per_window``: per-trial sample counts per event-time window with a
watermark, in append mode (a window is emitted once the watermark passes
its end; windows still open at the end of the input stay pending).
``new_files``: the names of new source files as a stream, for steps that open them in
their tasks.
``ingest_lines``: raw sensor lines to two tables, parsed and rejected ones with
their reason, each micro-batch in folders of its own.
``run_updates``: the same counts in update mode, open windows included.
All run with ``trigger(availableNow=True)``, i.e. as re-runnable batch jobs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import computed_once, cut, path_exists
from ..sources.files import FILE_SCHEMA, list_files, parse_imu_lines, rejected_imu_lines


def run_available(df: DataFrame, sink_path: str, checkpoint: str, mode: str = "append",
                  fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    w = (df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(sink_path)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_batches(df: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """``step`` over each micro-batch of what is there."""
    q = (df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def new_files(spark: SparkSession, source: str, known: str,
              max_files_per_trigger: int | None = None) -> DataFrame | None:
    """A stream of the files of ``source`` (FILE_SCHEMA); None before the first file. What is not in ``known`` yet, a
    table by the stream's checkpoint, is added to it and is the stream's input: which files
    are there is never held on the driver, as Spark's own file stream has it. With a limit
    the files found now are dealt out by it, the oldest first."""
    found = list_files(spark, source)
    if path_exists(spark, known):
        found = found.join(spark.read.schema(FILE_SCHEMA).parquet(known).select("path"), "path",
                           "left_anti")
    found = cut(found, "new-files")
    if not found.isEmpty():
        if max_files_per_trigger:
            found = found.orderBy("time", "path").coalesce(1)
        (found.write.mode("append").option("maxRecordsPerFile", max_files_per_trigger or 0)
         .parquet(known))
    elif not path_exists(spark, known):
        return None
    r = spark.readStream.schema(FILE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", 1)
    return r.parquet(known)


def run_updates(df: DataFrame, sink_path: str, checkpoint: str, keys: list[str]) -> DataFrame:
    """Update mode: each micro-batch's changed rows go to a folder of its own
    (a batch done again replaces it); returns the latest row of each key, open
    windows included."""
    def keep(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{sink_path}/batch={batch}")

    q = (df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(keep).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    rest = [c for c in df.columns if c not in keys]
    rows = df.sparkSession.read.parquet(sink_path)
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch").cast("long"))
                                    .alias("_r")).select(*keys, "_r.*"))


def ingest_lines(spark: SparkSession, source: str, sink: str, rejects: str, checkpoint: str,
                 max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """New text files of ``source`` -> parsed lines in ``sink``, the others with a reason
    in ``rejects`` (ST-2); returns both tables. A micro-batch writes one folder a table,
    named by its number, and a batch done again after a failure replaces them: each line
    is in one of the tables, once."""
    def both(lines: DataFrame, batch: int) -> None:
        with computed_once(lines) as held:  # the files are read once for the two tables
            parse_imu_lines(held).write.mode("overwrite").parquet(f"{sink}/batch={batch}")
            rejected_imu_lines(held).write.mode("overwrite").parquet(f"{rejects}/batch={batch}")

    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    run_batches(r.text(source), both, checkpoint)
    empty = spark.createDataFrame([], "value string")
    return tuple(spark.read.parquet(path).drop("batch") if path_exists(spark, path) else of(empty)
                 for path, of in ((sink, parse_imu_lines), (rejects, rejected_imu_lines)))


def ingest_files(spark: SparkSession, source: str, schema: T.StructType, sink: str,
                 checkpoint: str, fmt: str = "csv", header: bool = True,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of ``source`` -> appended to ``sink``; returns the sink."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", header).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    run_available(r.load(source), sink, checkpoint)
    return spark.read.parquet(sink)


def rate_per_window(stream: DataFrame, key: str, ts: str, window: str,
                    watermark: str) -> DataFrame:
    """Count of rows per key and tumbling event-time window (AG-14 / ST-3)."""
    return (stream.withWatermark(ts, watermark)
                  .groupBy(F.col(key), F.window(ts, window).alias("w"))
                  .agg(F.count(F.lit(1)).alias("n_rows"))
                  .select(key, F.col("w.start").alias("window_start"),
                          F.col("w.end").alias("window_end"), "n_rows"))
