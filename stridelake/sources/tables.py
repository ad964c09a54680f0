"""Readers for the benchmark tables and the column mappings that present
them as sensor-trial data (SURVEY 7.3). Every mapping is a projection over
a column-pruned Parquet scan, so filters and pruning reach the reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import epoch_ms

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- mapping E: events as camera frames / IMU samples ------------------------
SEATED_TYPES = ("view", "click", "signup")
PAST_VALUE = 28.0


def event_frames(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """(trial_id, frame_ts_ms, seated, past, event_id, *more) from ``events``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("trial_id"),
        epoch_ms("ts").alias("frame_ts_ms"),
        F.col("event_type").isin(*SEATED_TYPES).alias("seated"),
        (F.col("value") > F.lit(PAST_VALUE)).alias("past"),
        "event_id", *more)


def event_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(trial_id, host_ts_ms, accel_mag, gyro_mag, event_id): the event value
    stands in for both magnitudes."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("trial_id"), epoch_ms("ts").alias("host_ts_ms"),
                     F.col("value").alias("accel_mag"), F.col("value").alias("gyro_mag"),
                     "event_id")


# -- mapping L: lineitem as raw IMU rows -------------------------------------
def lineitem_imu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IMU-shaped rows: trial = supplier, host clock = ship date (ms), device
    clock = order key; accel/gyro derived from quantity, discount and tax
    (a tax of 0.08 becomes null so the null rule fires)."""
    li = table(spark, sf_dir, "lineitem")
    tax = F.nullif(F.col("l_tax"), F.lit(0.08))
    return li.select(
        F.col("l_suppkey").cast("string").alias("trial_id"),
        epoch_ms("l_shipdate").cast("double").alias("host_timestamp_ms"),
        F.col("l_orderkey").alias("imu_timestamp_ms"),
        (F.col("l_quantity") / F.lit(5.0)).alias("accel_x_g"),
        (F.col("l_discount") * F.lit(10.0)).alias("accel_y_g"),
        (tax * F.lit(10.0)).alias("accel_z_g"),
        (F.col("l_discount") * F.lit(25000.0)).alias("gyro_x_dps"),
        (F.col("l_tax") * F.lit(1000.0)).alias("gyro_y_dps"),
        F.col("l_quantity").alias("gyro_z_dps"),
        "l_linenumber", "l_partkey")


LINEITEM_TIEBREAK = ["imu_timestamp_ms", "l_linenumber", "l_partkey", "accel_x_g", "accel_y_g",
                     "accel_z_g", "gyro_x_dps", "gyro_y_dps", "gyro_z_dps"]


# -- mapping V: embeddings as pose landmarks ---------------------------------
FRAME_VALUES = 18  # six landmarks of three values
FRAMES_PER_VECTOR = 4


def embedding_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(trial_id, frame_ts_ms, v): each embedding as four frames of 18 values
    one after the other, which take every component; the last frame goes on
    with the first components."""
    em = table(spark, sf_dir, "embeddings")
    whole = F.concat("embedding", F.slice("embedding", 1, FRAME_VALUES))
    return em.select(F.col("label").cast("string").alias("trial_id"), "vec_id",
                     whole.alias("v"), F.explode(F.array(*map(F.lit, range(FRAMES_PER_VECTOR))))
                     .alias("f")).select(
        "trial_id", (F.col("vec_id") * FRAMES_PER_VECTOR + F.col("f")).alias("frame_ts_ms"),
        F.slice("v", F.col("f") * FRAME_VALUES + 1, F.lit(FRAME_VALUES)).alias("v"))


def embedding_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same frames as bytes: their values as text."""
    text = F.concat_ws(",", F.transform("v", lambda x: x.cast("string")))
    return embedding_frames(spark, sf_dir).select("trial_id", "frame_ts_ms",
                                                  F.encode(text, "UTF-8").alias("content"))


def embedding_landmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(trial_id, frame_ts_ms, landmarks): landmark 23+j (j = 0..5) has
    x = v[3j+1], y = v[3j+2], visibility = |v[3j+3]| * 10 (1-based)."""
    v = F.col("v")

    def lm(j: int) -> Column:
        return F.struct(F.lit(23 + j).cast("long").alias("landmark_id"),
                        F.get(v, 3 * j).alias("x"), F.get(v, 3 * j + 1).alias("y"),
                        F.lit(0.0).cast("float").alias("z"),
                        (F.abs(F.get(v, 3 * j + 2)) * F.lit(10.0)).cast("float").alias("visibility"),
                        F.lit(1.0).cast("float").alias("presence"))

    return embedding_frames(spark, sf_dir).select(
        "trial_id", "frame_ts_ms", F.array(*[lm(j) for j in range(6)]).alias("landmarks"))


def with_row_identity(df: DataFrame) -> DataFrame:
    """Add (source file, row index within file) to a Parquet scan: a stable
    per-row identity that survives recomputation, used as the last tie-break
    so fully identical rows still rank one after another."""
    return df.select("*", F.col("_metadata.file_path").alias("_src_file"),
                     F.col("_metadata.row_index").alias("_src_row"))
