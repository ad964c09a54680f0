"""FIXTURES B4: peaks, greedy spacing, CV,
and the motion metrics around trial events."""

import random

import pytest

from stridelake.operators.signals import local_peaks, min_spacing
from stridelake.operators.trials import motion_metrics
from stridelake.params import StepParams


def brute_greedy(ts, gap):
    out, last = [], None
    for t in sorted(ts):
        if last is None or t >= last + gap:
            out.append(t)
            last = t
    return out


def test_greedy_fixture(spark):
    df = spark.createDataFrame([("a", t) for t in (2500, 2700, 3000, 3600, 4000)],
                               "k string, t long")
    got = sorted(r.t for r in min_spacing(df, ["k"], "t", 300).collect())
    assert got == [2500, 3000, 3600, 4000]


def test_greedy_random_equals_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for k in range(4):
        t = 0
        for _ in range(rnd.randint(1, 60)):
            t += rnd.choice([1, 50, 90, 120, 300, 301, 700])
            rows.append((k, t))
    df = spark.createDataFrame(rows, "k long, t long")
    got = min_spacing(df, ["k"], "t", 300)
    got = sorted((r.k, r.t) for r in got.collect())
    exp = sorted((k, t) for k in range(4) for t in brute_greedy([t for kk, t in rows if kk == k],
                                                                 300))
    assert got == exp


def test_greedy_dense_hot_key(spark):
    """One key with most rows, several per instant: exact, and spread out."""
    from pyspark.sql import functions as F
    df = (spark.range(60_000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7))
        .alias("k"), (F.floor(F.col("id") / 20) * 17 + F.col("id") % 3).alias("t"), "id"))
    got = {}
    out = min_spacing(df, ["k"], "t", 300, tiebreak=["id"])
    for r in out.collect():
        got.setdefault(r.k, []).append(r.t)
    rows = {}
    for r in df.collect():
        rows.setdefault(r.k, []).append(r.t)
    assert {k: sorted(v) for k, v in got.items()} == {k: brute_greedy(v, 300)
                                                      for k, v in rows.items()}
    buckets = df.where("k = 'hot'").groupBy(F.floor(F.col("t") / 1200)).count()
    assert buckets.agg(F.max("count")).first()[0] < 2000  # of 48,000 rows


def test_greedy_rows_without_time_are_dropped(spark):
    df = spark.createDataFrame([("a", None), ("a", 5.5), ("a", 6.0), ("a", None)],
                               "k string, t double")
    assert [r.t for r in min_spacing(df, ["k"], "t", 1).collect()] == [5.5]
    assert min_spacing(df.limit(0), ["k"], "t", 1).count() == 0


def test_peaks_strict_and_not_at_edges(spark):
    vals = [(0, 1.5), (1, 1.0), (2, 1.3), (3, 1.3), (4, 1.0), (5, 1.1), (6, 1.0), (7, 1.2),
            (8, 1.0), (9, 2.0)]
    df = spark.createDataFrame([("a", t, v) for t, v in vals], "k string, t long, v double")
    got = [r.t for r in local_peaks(df, ["k"], "t", "v", 1.1, 4).collect()]
    assert got == [7]  # plateau, exactly 1.1, first and last sample are no peaks


def test_motion_metrics_fixture(spark):
    # one trial standing in [1000, 5000]; accel peaks at 2.5 s .. 4.0 s
    peaks = {2500: 1.5, 2700: 1.5, 3000: 1.5, 3600: 1.5, 4000: 1.5}
    imu = [("a", t, peaks.get(t, 1.0), 50.0 if t < 1000 else 10.0) for t in range(0, 6000, 100)]
    imu += [("b", t, 1.0, 1.0) for t in range(0, 1000, 100)]
    imu_df = spark.createDataFrame(imu, "trial_id string, host_ts_ms long, accel_mag double, "
                                        "gyro_mag double")
    ev = spark.createDataFrame([("a", 0, 1000, 5000), ("b", 0, None, None), ("c", 0, 500, None)],
                               "trial_id string, t0_ms long, t1_ms long, t4_ms long")
    m = {r.trial_id: r for r in motion_metrics(imu_df, ev, StepParams(bucket_ms=1000)).collect()}
    assert m["a"].n_steps == 4
    assert m["a"].step_cv == pytest.approx(0.16329931618554516, rel=1e-9)
    assert m["a"].peak_standing_dps == 50.0
    assert (m["b"].n_steps, m["b"].step_cv, m["b"].peak_standing_dps) == (0, None, None)
    assert "c" not in m  # no IMU rows: no metrics row (null after the fuse join)


def test_two_steps_give_no_cv(spark):
    imu = [("a", t, 1.5 if t in (1500, 2500) else 1.0, 1.0) for t in range(1000, 3100, 100)]
    imu_df = spark.createDataFrame(imu, "trial_id string, host_ts_ms long, accel_mag double, "
                                        "gyro_mag double")
    ev = spark.createDataFrame([("a", 1000, 1000, None)],
                               "trial_id string, t0_ms long, t1_ms long, t4_ms long")
    r = motion_metrics(imu_df, ev, StepParams(bucket_ms=500)).first()
    assert (r.n_steps, r.step_cv) == (2, None)
