"""The layer chains (PL-2 .. PL-4) as compositions of incremental steps.

Paths are parameters (any Hadoop-compatible store). Each function returns
the ``StepResult`` of every step it ran; re-running with unchanged inputs
writes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.inference import Detector, detect_landmarks
from ..operators.pose import pose_features
from ..operators.quality import clean, tag_imu
from ..operators.signals import magnitude
from ..operators.trials import fuse, motion_metrics, trial_events
from ..params import PoseParams, QualityParams, StepParams, TrialParams
from ..sources.files import arrow_reads, read_frames, read_imu_csv, read_imu_files
from ..session import cut, path_exists, per_key
from ..sources.tables import with_row_identity
from ..streaming.ingest import new_files, run_batches
from .layers import (LayerSource, StepResult, loaded_keys, publish, read_latest, read_layer,
                     run_layer)


@dataclass(frozen=True)
class Paths:
    imu_source: str
    camera_source: str
    bronze_imu: str
    bronze_camera: str
    silver_imu: str
    silver_camera: str
    gold_camera: str
    results: str


def imu_chain(spark: SparkSession, p: Paths, batch_id: str | None = None,
              qp: QualityParams = QualityParams()) -> list[StepResult]:
    """CSV chunks -> bronze -> silver (quality rules, duplicates removed)."""
    out = [run_layer(spark, read_imu_csv(spark, p.imu_source), lambda d: d, p.bronze_imu,
                     order=["host_timestamp_ms"], batch_id=batch_id)]
    obs = Observation("silver_quality")

    def to_silver(d: DataFrame) -> DataFrame:
        t = tag_imu(d.drop("batch_id"), qp, tiebreak=["imu_timestamp_ms", "_src_file", "_src_row"])
        # rows seen / rejected, counted while the silver rows are written
        t = t.observe(obs, F.count(F.lit(1)).alias("rows"),
                      F.count_if(~F.col("quality_ok")).alias("rejected"))
        return clean(t).drop("_src_file", "_src_row")

    out.append(run_layer(spark, LayerSource(p.bronze_imu, with_row_identity), to_silver,
                         p.silver_imu, order=["host_timestamp_ms"], batch_id=batch_id,
                         observation=obs))
    return out


def camera_chain(spark: SparkSession, p: Paths, detector_factory: Callable[[], Detector],
                 batch_id: str | None = None,
                 pp: PoseParams = PoseParams()) -> list[StepResult]:
    """Frame files -> bronze -> landmarks (silver) -> per-frame flags (gold)."""
    out = [run_layer(spark, read_frames(spark, p.camera_source), lambda d: d, p.bronze_camera,
                     order=["frame_ts_ms"], batch_id=batch_id)]
    out.append(run_layer(spark, LayerSource(p.bronze_camera),
                         lambda d: detect_landmarks(d, detector_factory), p.silver_camera,
                         order=["frame_ts_ms"], batch_id=batch_id))

    def to_gold(d: DataFrame) -> DataFrame:
        f = pose_features(d, pp)
        return f.select("trial_id", "frame_ts_ms", "seated", "past")

    out.append(run_layer(spark, LayerSource(p.silver_camera), to_gold, p.gold_camera,
                         order=["frame_ts_ms"], batch_id=batch_id))
    return out


def fusion(spark: SparkSession, p: Paths, batch_id: str | None = None,
           tp: TrialParams = TrialParams(), sp: StepParams = StepParams()) -> StepResult:
    """Gold camera flags + silver IMU -> one result row per new trial. Driven
    by the camera table; trials with IMU only stay pending (no_camera). A
    result is final, so nothing is written before both tables are there."""
    if any(loaded_keys(spark, x) is None for x in (p.gold_camera, p.silver_imu)):
        return StepResult("missing_upstream")

    def to_results(frames: DataFrame) -> DataFrame:
        # read for the events and again for the fused rows: one written copy
        ev = cut(trial_events(frames.drop("batch_id"), tp), "events")
        # the runs of the new trials, no others
        imu = read_layer(spark, p.silver_imu, keys=ev)
        samples = imu.select(
            "trial_id", F.col("host_timestamp_ms").alias("host_ts_ms"), "imu_timestamp_ms",
            magnitude("accel_x_g", "accel_y_g", "accel_z_g").alias("accel_mag"),
            magnitude("gyro_x_dps", "gyro_y_dps", "gyro_z_dps").alias("gyro_mag"))
        return fuse(ev, motion_metrics(samples, ev, sp, tiebreak=["imu_timestamp_ms"]))

    return run_layer(spark, LayerSource(p.gold_camera), to_results, p.results, batch_id=batch_id)


def imu_file_chain(spark: SparkSession, p: Paths, checkpoint: str,
                   qp: QualityParams = QualityParams(),
                   max_files_per_trigger: int | None = None) -> DataFrame | None:
    """The IMU chain by files (D22): new CSV files of any trial, loaded before or not, go
    to bronze; the trials they belong to are worked out again from all their bronze rows
    and replace themselves in silver. Returns silver (None before the first file). Both
    layers are this function's own: ``read_latest`` reads silver.

    Each micro-batch is a run named by its number, and a batch done again after a failure
    replaces its runs, so a file counts once. A file costs the bronze runs of its trial
    again, which are few as long as a trial's files come close together.

    What streams are the files' names, found and opened by tasks: Spark's own file stream
    holds every file of the source on the driver. It stays for stores that Arrow can't
    open and for checkpoints that it began."""
    def step(rows: DataFrame, batch: int) -> None:
        place = f"batch_id={batch:012d}/run_id=files"
        publish(rows, p.bronze_imu, place)
        touched = per_key(spark.read.parquet(f"{p.bronze_imu}/_keys/{place}")
                          .where(F.col("trial_id").isNotNull()), "touched")
        bronze = with_row_identity(read_layer(spark, p.bronze_imu, keys=touched))
        t = tag_imu(bronze.join(touched, "trial_id", "left_semi").drop("batch_id"), qp,
                    tiebreak=["imu_timestamp_ms", "_src_file", "_src_row"])
        publish(clean(t).drop("_src_file", "_src_row"), p.silver_imu, place)

    if path_exists(spark, f"{checkpoint}/offsets") or not arrow_reads(spark, p.imu_source):
        run_batches(read_imu_csv(spark, p.imu_source, streaming=True,
                                 max_files_per_trigger=max_files_per_trigger), step, checkpoint)
    elif (found := new_files(spark, p.imu_source, f"{checkpoint}/files",
                             max_files_per_trigger)) is not None:
        run_batches(found, lambda files, batch: step(read_imu_files(files, p.imu_source), batch),
                    f"{checkpoint}/stream")
    return read_latest(spark, p.silver_imu)
