"""Read-side reports over the result table (PL-6): ranking, labels, phase
marks and shares, signal values at the marks, filled state series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import fmt_or_dash, short_id
from ..operators.relations import global_rank
from ..operators.signals import interpolate_at
from ..session import per_key

PHASES = [("stand_up_s", "end of standing up"), ("to_mark_s", "mark (out)"),
          ("turn_back_s", "mark (back)"), ("back_to_chair_s", "end of test")]


def ranked_results(results: DataFrame, key: str = "trial_id") -> DataFrame:
    """Longest tests first, unfinished (null duration) last (SO-2)."""
    return global_rank(results, [F.col("duration_s").desc_nulls_last(), F.col(key).asc()])


def result_labels(results: DataFrame, key: str = "trial_id") -> DataFrame:
    """Selector label and display strings of the result card."""
    sid = short_id(F.col(key).cast("string"))
    dur = F.round(F.col("duration_s"), 1)
    label = F.concat(sid, F.lit(" — "),
                     F.when(F.col("finished"), F.concat(F.format_string("%.1f", dur), F.lit("s")))
                      .otherwise(F.lit("unfinished")),
                     F.when(F.col("frail"), F.lit(" ⚠")).otherwise(F.lit("")))
    frail_txt = (F.when(F.col("frail").isNull(), F.lit("—"))
                  .when(F.col("frail"), F.lit("yes")).otherwise(F.lit("no")))
    return results.select(
        key, label.alias("label"),
        F.when(dur.isNotNull(), F.concat(F.format_string("%.1f", dur), F.lit("s")))
         .otherwise(F.lit("—")).alias("duration_txt"),
        frail_txt.alias("frail_txt"),
        fmt_or_dash(F.col("attempts"), "%d").alias("attempts_txt"),
        *([fmt_or_dash(F.col("n_steps"), "%d").alias("steps_txt"),
           F.when(F.col("peak_standing_dps").isNotNull(),
                  F.concat(F.format_string("%.0f", F.round(F.col("peak_standing_dps"), 0)),
                           F.lit("°/s"))).otherwise(F.lit("—")).alias("peak_txt")]
          if "n_steps" in results.columns else []))


def phase_marks(results: DataFrame, key: str = "trial_id") -> DataFrame:
    """Cumulative phase ends in seconds since t0, stopping at the first
    unknown phase (AG-13). One row per reached mark."""
    acc = None
    marks = []
    for i, (c, label) in enumerate(PHASES, start=1):
        acc = F.col(c) if acc is None else acc + F.col(c)  # null once any is null
        marks.append(F.struct(F.lit(i).alias("phase_no"), F.lit(label).alias("phase"),
                              acc.alias("t_mark_s")))
    m = results.select(key, *[c for c in ("t0_ms",) if c in results.columns],
                       F.explode(F.array(*marks)).alias("m"))
    return m.filter(F.col("m.t_mark_s").isNotNull()).select("*", "m.*").drop("m")


def phase_shares(results: DataFrame, key: str = "trial_id") -> DataFrame:
    """Share of each phase in the total, for trials with all four (AG-12)."""
    total = sum((F.col(c) for c, _ in PHASES[1:]), F.col(PHASES[0][0]))
    rows = [F.struct(F.lit(i).alias("phase_no"), F.lit(label).alias("phase"),
                     F.col(c).alias("seconds"), F.try_divide(F.col(c), total).alias("share"))
            for i, (c, label) in enumerate(PHASES, start=1)]
    known = F.lit(True)
    for c, _ in PHASES:
        known = known & F.col(c).isNotNull()
    return (results.filter(known).select(key, F.explode(F.array(*rows)).alias("s"))
                   .select(key, "s.*"))


def values_at_marks(samples: DataFrame, marks: DataFrame, key: str, ts: str, value: str,
                    out: str = "value_at") -> DataFrame:
    """Signal value at each phase mark (absolute time t0 + mark), JN-6."""
    m = marks.select(key, "phase_no",
                     (F.col("t0_ms") + F.col("t_mark_s") * F.lit(1000.0)).alias("at_ms"))
    return interpolate_at(samples, m, [key], ts, value, "at_ms", ["phase_no"], out=out)


# -- per-trial series for the report page (FLT-4, PL-6) ------------------------
def _since_t0(rows: DataFrame, events: DataFrame, trial_id: str | None, key: str, ts: str):
    """``rows`` (of one trial, or of all) with seconds since the trial's t0."""
    t0 = events.select(key, "t0_ms")
    if trial_id is None:
        t0 = per_key(t0, "t0")  # so that a trial with most of the rows can be split
    else:
        t0 = t0.filter(F.col(key) == F.lit(trial_id))
    return (rows.join(t0, key, "left")
                .withColumn("t_s", (F.col(ts) - F.col("t0_ms")) / F.lit(1000.0)).drop("t0_ms"))


def state_series(gold_camera: DataFrame, events: DataFrame, trial_id: str | None = None,
                 key: str = "trial_id", ts: str = "frame_ts_ms",
                 bucket_ms: int = 10 * 60 * 1000, tiebreak: Sequence[str] = ()) -> DataFrame:
    """A trial's states, filled forward then backward, with seconds since
    the trial's t0 (the same zero as the phase marks), in time order; without
    ``trial_id`` those of all trials, in no order. The trial filter is a
    plain predicate, so it reaches the Parquet scan (row-group statistics of
    the trial-clustered layer files)."""
    from ..operators.signals import fill_states
    if trial_id is not None:
        gold_camera = gold_camera.filter(F.col(key) == F.lit(trial_id))
    out = _since_t0(fill_states(gold_camera, [key], ts, ["seated", "past"], bucket_ms, tiebreak),
                    events, trial_id, key, ts)
    return out if trial_id is None else out.orderBy(ts, *tiebreak)


def imu_series(silver_imu: DataFrame, events: DataFrame, trial_id: str | None = None,
               key: str = "trial_id", ts: str = "host_timestamp_ms") -> DataFrame:
    """A trial's IMU samples with accel/gyro magnitudes and seconds since t0, in
    time order; without ``trial_id`` those of all trials, in no order."""
    from ..operators.signals import magnitude
    if trial_id is not None:
        silver_imu = silver_imu.filter(F.col(key) == F.lit(trial_id))
    out = _since_t0(silver_imu, events, trial_id, key, ts).select(
        "*", magnitude("accel_x_g", "accel_y_g", "accel_z_g").alias("accel_mag"),
        magnitude("gyro_x_dps", "gyro_y_dps", "gyro_z_dps").alias("gyro_mag"))
    return out if trial_id is None else out.orderBy(ts)
