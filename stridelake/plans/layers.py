"""Incremental medallion layers (PL-1 .. PL-5, SRC-3..6, SNK-1..3).

A layer step reads its upstream, keeps only trials the target does not have
yet (left anti join on the trial key), transforms, and appends. It is a
no-op when the upstream table is missing or nothing is new, and safe to
re-run: a run writes to a hidden staging folder, moves it to a partition of its
own (``batch_id``, ``run_id``), and then writes the run's keys to a small table,
whose success marker is the run's completion. Readers take completed runs only, so
a move that an object store carries out as copies, and that breaks half-way, shows
nothing, and the next run loads those trials. Loaded trials are never touched,
whatever batch id is used again. Two runs at once on one target are not
coordinated. Rows inside a run are clustered by (trial, time) so Parquet
min/max statistics prune single-trial reads; no directory per trial.

What is new is found on the key columns alone, on the layer's side on the runs'
key tables: the difference of the two key sets is written once, tested, and then
picks the rows.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import chunk_file_name
from ..session import bounded, cut, full_uri, matching_paths, move, per_key, remove

BATCH = "batch_id"
RUN = "run_id"
WRITE_BUCKET_MS = 10 * 60 * 1000


@dataclass
class StepResult:
    status: str  # "missing_upstream" | "nothing_new" | "written"
    batch_id: str | None = None
    metrics: dict | None = None  # observed during the write (no extra pass)


KEYS = "_keys"  # hidden from a plain read of the folder


def completed_runs(spark: SparkSession, path: str) -> list[str]:
    """``batch_id=.../run_id=...`` of the runs that are published whole."""
    done = matching_paths(spark, f"{path}/{KEYS}/{BATCH}=*/{RUN}=*/_SUCCESS")
    return sorted("/".join(p.split("/")[-3:-1]) for p in done)


def _key_tables(spark: SparkSession, path: str, runs: list[str]) -> DataFrame:
    """(batch_id, run_id, key column) of the given runs."""
    return spark.read.option("basePath", f"{path}/{KEYS}").parquet(
        *(f"{path}/{KEYS}/{r}" for r in runs))


def runs_with(spark: SparkSession, path: str, keys: DataFrame, key: str = "trial_id") -> list[str]:
    """The completed runs that hold one of ``keys``, from the key tables alone. A list of
    runs, as the folder's listing is, not of keys, comes to the driver."""
    runs = completed_runs(spark, path)
    if not runs:
        return []
    tables = _key_tables(spark, path, runs)
    if key not in tables.columns:
        return runs
    hit = tables.join(keys.select(key), key, "left_semi").select(BATCH, RUN).distinct()
    return sorted(f"{BATCH}={r[BATCH]}/{RUN}={r[RUN]}" for r in hit.collect())


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None,
               columns: list[str] | None = None, fmt: str = "parquet",
               keys: DataFrame | None = None, key: str = "trial_id") -> DataFrame | None:
    """Column-pruned layer read, completed runs only; an absent table gives an empty
    frame of ``schema`` (or None without a schema). A folder without any run is an
    ordinary table and read as such. With ``keys`` only the runs that hold one of them
    are read; these may hold other keys too."""
    df = None
    if fmt == "parquet" and (runs := completed_runs(spark, path)):
        some = runs if keys is None else runs_with(spark, path, keys, key)
        df = spark.read.option("basePath", path).parquet(*(f"{path}/{r}" for r in some or runs[:1]))
        if not some:
            df = df.limit(0)
    elif fmt == "parquet" and matching_paths(spark, f"{path}/{BATCH}=*/{RUN}=*"):
        pass  # none of its runs is complete
    elif matching_paths(spark, f"{path}/[^_.]*" if fmt == "parquet" else path):
        df = spark.read.format(fmt).load(path)
    if df is not None:
        df = df.drop(RUN)
    elif schema is not None:
        df = spark.createDataFrame([], schema)
    else:
        return None
    return df.select(*columns) if columns else df


def read_latest(spark: SparkSession, path: str, key: str = "trial_id") -> DataFrame | None:
    """A layer whose runs replace each other: of each key the rows of the run with the
    greatest batch id (text order). Which run counts is found on the key tables."""
    runs = completed_runs(spark, path)
    if not runs:
        return None
    last = per_key(_key_tables(spark, path, runs).groupBy(key).agg(F.max(BATCH).alias(BATCH)),
                   "latest")
    return read_layer(spark, path).join(last, [key, BATCH], "left_semi")


def publish(rows: DataFrame, target: str, place: str, key: str = "trial_id") -> None:
    """Writes a run under a name of the caller's, its keys last. Done again, it replaces
    itself: the key table goes first, so that a half-written run doesn't count."""
    spark = rows.sparkSession
    remove(spark, f"{target}/{KEYS}/{place}")
    rows.drop(BATCH, RUN).write.mode("overwrite").parquet(f"{target}/{place}")
    (spark.read.parquet(f"{target}/{place}").select(key).distinct()
          .write.mode("overwrite").parquet(f"{target}/{KEYS}/{place}"))


@dataclass(frozen=True)
class LayerSource:
    """A layer as the upstream of another: a step finds its new keys on the key tables
    and reads the runs that hold them, no others. ``prepare`` adds columns to the scan."""
    path: str
    prepare: Callable[[DataFrame], DataFrame] = lambda d: d


def loaded_keys(spark: SparkSession, path: str, key: str = "trial_id",
                fmt: str = "parquet") -> DataFrame | None:
    """Distinct keys of a layer, from its runs' key tables."""
    if fmt == "parquet" and (runs := completed_runs(spark, path)):
        keys = spark.read.parquet(*(f"{path}/{KEYS}/{r}" for r in runs))
        if key in keys.columns:
            return keys.select(key).distinct()
    rows = read_layer(spark, path, fmt=fmt)
    return None if rows is None else rows.select(key).distinct()


def run_layer(spark: SparkSession, upstream: DataFrame | LayerSource | None,
              transform: Callable[[DataFrame], DataFrame], target: str, *,
              key: str = "trial_id", order: list[str] | None = None,
              batch_id: str | None = None, fmt: str = "parquet",
              observation=None) -> StepResult:
    """One incremental step; see module doc. ``observation`` is a
    ``pyspark.sql.Observation`` the transform attached with ``observe``;
    its metrics are read after the write (same pass, no second action)."""
    if upstream is None:
        return StepResult("missing_upstream")
    layer = upstream if isinstance(upstream, LayerSource) else None
    there = upstream.select(key).distinct() if layer is None else loaded_keys(spark, layer.path, key)
    if there is None:
        return StepResult("missing_upstream")
    done = loaded_keys(spark, target, key, fmt)
    if done is not None:
        # a row without a key can't be told from a loaded one: only a first run takes it
        keys = cut(there.where(F.col(key).isNotNull()).join(cut(done, "done"), key, "left_anti"),
                   "new-keys")
        if keys.isEmpty():
            return StepResult("nothing_new")
        rows = upstream if layer is None else layer.prepare(
            read_layer(spark, layer.path, keys=keys, key=key))
        pending = rows.join(bounded(keys, keys.count()), key, "left_semi")
    else:
        pending = upstream if layer is None else layer.prepare(read_layer(spark, layer.path))
        if pending.isEmpty():
            return StepResult("nothing_new")
    out = transform(pending).drop(BATCH, RUN)
    bid = batch_id or time.strftime("%Y%m%dT%H%M%S", time.gmtime())
    run = uuid.uuid4().hex
    if order:
        # files clustered by trial and time; hashing on (trial, time bucket)
        # splits one long trial over several tasks without a sampling pass
        bucket = F.floor(F.col(order[0]) / F.lit(WRITE_BUCKET_MS))
        out = out.repartition(key, bucket).sortWithinPartitions(key, *order)
    if fmt == "parquet":
        staged = f"{target}/_staging-{run}"
        out.write.parquet(staged)
        place = f"{BATCH}={bid}/{RUN}={run}"
        move(spark, staged, f"{target}/{place}")
        (spark.read.parquet(f"{target}/{place}").select(key).distinct()
              .write.parquet(f"{target}/{KEYS}/{place}"))
    else:  # a format with commits of its own
        (out.withColumns({BATCH: F.lit(bid), RUN: F.lit(run)}).write.format(fmt).mode("append")
            .partitionBy(BATCH, RUN).save(target))
    return StepResult("written", bid, observation.get if observation is not None else None)


def pending_report(spark: SparkSession, sources: dict[str, DataFrame], done_path: str,
                   key: str = "trial_id", primary: str = "camera") -> DataFrame:
    """Trials present in a source and absent from the final table (PL-5)."""
    from ..operators.relations import pending
    done = loaded_keys(spark, done_path, key)
    if done is None:
        done = spark.createDataFrame([], T.StructType([T.StructField(key, T.StringType())]))
    return pending(sources, done, key, primary).orderBy(key)


def write_chunked_csv(df: DataFrame, path: str, key: str = "trial_id",
                      ts: str = "host_timestamp_ms", rows_per_file: int = 500,
                      bucket_ms: int = 10 * 60 * 1000, tiebreak: Sequence[str] = ()) -> None:
    """IMU samples as CSV files of ``rows_per_file`` rows per trial folder,
    in time order (SNK-4), named by the chunk's first time and number (from 0).
    Chunk numbers come from the bucketed running count, and files are written
    by (trial, chunk) tasks, so a very long trial is written by many tasks. A
    file written again by a repeated task is the same file."""
    from ..operators.greedy import whole_groups
    from ..operators.sequence import scan
    path = full_uri(df.sparkSession, path)
    columns = [c for c in df.columns if c != key]
    c = scan(df.withColumn("_one", F.lit(1).cast("long")), [key], ts, bucket_ms,
             tiebreak=tiebreak, cumsum=["_one"])
    c = c.withColumn("_chunk", F.floor((F.col("cum__one") - 1) / F.lit(rows_per_file)))
    c = (c.withColumn("_g", F.xxhash64(key, "_chunk")).repartition(key, "_chunk")
         .sortWithinPartitions(key, "_chunk", "cum__one")
         .withColumn("_name", chunk_file_name(F.coalesce(F.col(ts).cast("bigint"), F.lit(0)),
                                              "_chunk"))
         .select(F.col(key).cast("string").alias(key), *columns, "_g", "_name"))

    def write(batches):
        from pyarrow import csv, fs
        store, top = fs.FileSystem.from_uri(path)
        for t, cuts in whole_groups(batches):
            for a, b in zip(cuts[:-1], cuts[1:]):
                folder = f"{top}/{key}={t.column(key)[int(a)].as_py()}"
                store.create_dir(folder, recursive=True)
                with store.open_output_stream(f"{folder}/{t.column('_name')[int(a)].as_py()}") as f:
                    csv.write_csv(t.select(columns).slice(a, b - a), f)
            yield from t.select([key]).to_batches()
    c.mapInArrow(write, f"{key} string").write.format("noop").mode("overwrite").save()
