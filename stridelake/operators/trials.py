"""Trial events (camera states -> phases) and motion metrics (IMU), fused.

Everything here is DataFrame expressions: the state series is smoothed with
a halo range frame, cut into runs, and the chained event search (t1 .. t4)
is evaluated on the run tables, which are much smaller than the frames. Each
chained step is a join of the runs with one row per trial plus a partial
aggregate, so a very long trial never lands in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import StepParams, TrialParams
from ..session import BROADCAST_MAX_ROWS, bounded, computed_once, cut, per_key
from .sequence import BKT, scan
from .signals import interval_variation, local_peaks, min_spacing, smooth_flags

def smoothed_states(frames: DataFrame, params: TrialParams, key: str = "trial_id",
                    ts: str = "frame_ts_ms", seated: str = "seated", past: str = "past",
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """Frames with both states known, smoothed: (key, ts, s_seated, s_past, _bkt)."""
    valid = (frames.filter(F.col(seated).isNotNull() & F.col(past).isNotNull())
                   .select(key, ts, *tiebreak, F.col(seated).alias("seated"),
                           F.col(past).alias("past")))
    sm = smooth_flags(valid, [key], ts, ["seated", "past"], params.dwell_ms, params.bucket_ms,
                      keep_bucket=True)
    return sm.select(key, ts, *tiebreak, BKT, "s_seated", "s_past")


def state_run_tables(states: DataFrame, params: TrialParams, key: str, ts: str,
                     tiebreak: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, int]:
    """Runs of the smoothed seated and past states: one ordered scan, one
    aggregation for both signals, written once (lineage cut) because the
    chained event search reads it several times. Also returns the exact
    number of run rows, an upper bound of every per-trial table below."""
    with computed_once(states) as st:  # the smoothing runs once for both scan branches
        return _run_tables(st, params, key, ts, tiebreak)


def _run_tables(states, params, key, ts, tiebreak):
    sc = scan(states, [key], ts, params.bucket_ms, tiebreak=tiebreak, lead=[ts],
              runs=["s_seated", "s_past"], bucket_col=BKT)
    both = sc.select(key, ts, F.explode(F.array(
        F.struct(F.lit(0).alias("sig"), F.col("run_s_seated").alias("run_no"),
                 F.col("s_seated").alias("v"), F.lit(None).cast("long").alias("nx")),
        F.struct(F.lit(1).alias("sig"), F.col("run_s_past").alias("run_no"),
                 F.col("s_past").alias("v"),
                 # steps to a later time: a frame time may come several times
                 F.when(F.col(f"next_{ts}") > F.col(ts), F.col(f"next_{ts}")).alias("nx")))
        ).alias("r"))
    runs = (both.groupBy(key, F.col("r.sig").alias("sig"), F.col("r.run_no").alias("run_no"))
                .agg(F.max("r.v").alias("value"), F.min(ts).alias("t_start"),
                     F.max(ts).alias("t_end"), F.min("r.nx").alias("t_second")))
    runs = cut(runs, "runs")
    seated_runs = runs.filter(F.col("sig") == 0).drop("sig", "t_second")
    past_runs = runs.filter(F.col("sig") == 1).drop("sig")
    return seated_runs, past_runs, runs.count()


def event_chain(seated_runs: DataFrame, past_runs: DataFrame, key: str,
                bound_rows: int | None = None) -> DataFrame:
    """t0 .. t4 per trial from the run tables.

    t1 = start of the last standing run (only if there was at least one
    seated -> standing transition); t2 = first instant >= t1 past the mark;
    t3 = first instant > t2 back before the mark; t4 = first instant > t3
    seated. A frame time may come several times: the smoothing window goes by
    time, so frames of one time have one state and are in one run. ``bound_rows`` (rows of the run tables) bounds every
    per-trial table; under the broadcast limit they are broadcast. Above it each is
    written once, as the next search and the result both read it: a stage then holds
    one search, not all before it again.
    """
    def b(df):
        if bound_rows is None or bound_rows <= BROADCAST_MAX_ROWS:
            return df if bound_rows is None else bounded(df, bound_rows)
        return per_key(df, "chain")

    a = (seated_runs.groupBy(key).agg(
        F.min("t_start").alias("t0"),
        F.count_if(~F.col("value") & (F.col("run_no") > 1)).cast("int").alias("attempts"),
        F.max(F.when(~F.col("value"), F.col("t_start"))).alias("_t1_any")))
    a = a.select(key, "t0", "attempts",
                 F.when(F.col("attempts") > 0, F.col("_t1_any")).alias("t1"))
    t1 = b(a.filter(F.col("t1").isNotNull()).select(key, "t1"))

    # t2: inside a past run that ends at/after t1 -> max(start, t1)
    t2 = b(past_runs.filter(F.col("value")).join(t1, key)
           .filter(F.col("t_end") >= F.col("t1"))
           .groupBy(key).agg(F.min(F.greatest(F.col("t_start"), F.col("t1"))).alias("t2")))
    # t3: start of the first not-past run after t2, and the first time after it
    t3 = b(past_runs.filter(~F.col("value")).join(t2, key)
           .filter(F.col("t_start") > F.col("t2"))
           .groupBy(key).agg(F.min("t_start").alias("t3"),
                             F.min_by("t_second", "t_start").alias("t3_next")))
    # t4: first seated instant after t3
    t4 = b(seated_runs.filter(F.col("value")).join(t3, key)
           .filter(F.col("t_end") > F.col("t3"))
           .groupBy(key).agg(F.min(F.when(F.col("t_start") > F.col("t3"), F.col("t_start"))
                                   .otherwise(F.col("t3_next"))).alias("t4")))
    return (a.join(t2, key, "left").join(t3.drop("t3_next"), key, "left")
             .join(t4, key, "left"))


def trial_events(frames: DataFrame, params: TrialParams = TrialParams(), key: str = "trial_id",
                 ts: str = "frame_ts_ms", seated: str = "seated", past: str = "past",
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per trial that has frames (even when no state is known).

    Columns: key, finished, frail, attempts, duration_s, stand_up_s,
    to_mark_s, turn_back_s, back_to_chair_s, t0_ms, t1_ms, t4_ms.
    """
    trials = frames.select(key).distinct()
    states = smoothed_states(frames, params, key, ts, seated, past, tiebreak)
    seated_runs, past_runs, n_runs = state_run_tables(states, params, key, ts, tiebreak)
    ch = event_chain(seated_runs, past_runs, key, n_runs)
    e = trials.join(bounded(ch, n_runs), key, "left")

    def rel(c):  # seconds since t0, as the reference computes them
        return (F.col(c) - F.col("t0")) / F.lit(1000.0)

    done = F.col("t4").isNotNull()
    return e.select(
        key,
        done.alias("finished"),
        F.when(done, rel("t4") >= F.lit(params.frail_s)).alias("frail"),
        F.coalesce(F.col("attempts"), F.lit(0)).cast("int").alias("attempts"),
        F.when(done, rel("t4")).alias("duration_s"),
        rel("t1").alias("stand_up_s"),
        F.when(done, rel("t2") - rel("t1")).alias("to_mark_s"),
        F.when(done, rel("t3") - rel("t2")).alias("turn_back_s"),
        F.when(done, rel("t4") - rel("t3")).alias("back_to_chair_s"),
        F.col("t0").alias("t0_ms"), F.col("t1").alias("t1_ms"), F.col("t4").alias("t4_ms"),
    )


def motion_metrics(imu: DataFrame, events: DataFrame, params: StepParams = StepParams(),
                   key: str = "trial_id", ts: str = "host_ts_ms", accel: str = "accel_mag",
                   gyro: str = "gyro_mag", tiebreak: Sequence[str] = ()) -> DataFrame:
    """IMU metrics per trial bounded by the trial events (AG-11).

    peak_standing_dps: max gyro magnitude in [t0, t1]; n_steps: accepted
    accel peaks in [t1, t4] (or [t1, end) when unfinished); step_cv: CV of
    step intervals (population std / mean), null below two intervals.
    Trials with IMU rows but no t1 get (null, 0, null); trials without IMU
    rows get no row (null after the fuse join).
    """
    # one row per trial, written once; broadcast when its exact size is small.
    # The peak and the step search below each read only their own columns of
    # the IMU rows (a pruned scan and a broadcast or narrow join), which is
    # cheaper than holding the joined rows for both.
    ev = cut(events.select(key, "t0_ms", "t1_ms", "t4_ms"), "bounds")
    j = imu.select(key, ts, *tiebreak, accel, gyro).join(bounded(ev, ev.count()), key)
    t = F.col(ts)
    peak = j.groupBy(key).agg(F.max(F.when((t >= F.col("t0_ms")) & (t <= F.col("t1_ms")),
                                           F.col(gyro))).alias("peak_standing_dps"))
    standing = j.filter(F.col("t1_ms").isNotNull() & (t >= F.col("t1_ms"))
                        & (F.col("t4_ms").isNull() | (t <= F.col("t4_ms"))))
    cand = local_peaks(standing.select(key, ts, *tiebreak, accel), [key], ts, accel,
                       params.threshold, params.bucket_ms, tiebreak)
    steps = min_spacing(cand.select(key, ts, *tiebreak), [key], ts, params.min_gap_ms,
                        tiebreak=tiebreak)
    st = interval_variation(steps, [key], ts, params.bucket_ms, tiebreak=tiebreak,
                            count="n_steps", out="step_cv")
    st = st.withColumn("n_steps", F.col("n_steps").cast("int"))
    return (peak.join(st, key, "left")
                .select(key, "peak_standing_dps",
                        F.coalesce(F.col("n_steps"), F.lit(0)).alias("n_steps"), "step_cv"))


def fuse(events: DataFrame, metrics: DataFrame, key: str = "trial_id") -> DataFrame:
    """Result table: every trial event row, IMU metrics where present (JN-3)."""
    return events.drop("t0_ms", "t1_ms", "t4_ms").join(metrics, key, "left")
