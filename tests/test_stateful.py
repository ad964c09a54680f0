"""Keyed state over streams: totals and sessions over several runs of one checkpoint."""

import random

import pytest
from pyspark.sql import functions as F

from stridelake.operators.relations import active_session
from stridelake.operators.signals import window_counts
from stridelake.session import scratch_path
from stridelake.streaming.stateful import PROVIDER, live_sessions, run_stateful, running_total

HOUR = 3_600_000
EVENT = "trial_id string, id long, ms long, kind string"


def drop(spark, path, rows):
    (spark.createDataFrame(rows, EVENT).withColumn("ts", F.timestamp_millis("ms"))
     .coalesce(1).write.mode("append").parquet(path))


def stream(spark, path):
    return spark.readStream.schema(EVENT + ", ts timestamp").parquet(path)


def test_running_total_goes_on_after_a_restart(spark):
    src, sink, ck = (scratch_path(spark, n) for n in ("rt-src", "rt-sink", "rt-ck"))
    rng = random.Random(3)
    rows = [(rng.choice("aab"), i, rng.randrange(10 * HOUR) + 20 * HOUR * part, "s")
            for part in range(3) for i in range(60)]
    rows += [(None, 1, 5, "s"), ("a", 2, None, "s"), ("a", 7, 3 * HOUR, "s")]
    rows += [("a", 7, 3 * HOUR, "s")]  # a repeated row counts again
    before = spark.conf.get(PROVIDER, None)
    sizes = []
    for part in range(3):  # each run starts from the checkpoint of the last
        drop(spark, src, [r for r in rows if (r[2] or 0) // (20 * HOUR) == part])
        run_stateful(running_total(stream(spark, src), "trial_id", "ts", "1 hour", "1 hour"),
                     sink, ck)
        sizes.append(spark.read.parquet(sink).count())
    assert 0 < sizes[0] < sizes[1] < sizes[2]
    assert spark.conf.get(PROVIDER, None) == before
    got = sorted(map(tuple, spark.read.parquet(sink).collect()))
    whole = spark.createDataFrame([r for r in rows if r[0] and r[2] is not None], EVENT)
    late = max(r[2] for r in rows if r[2] is not None) - HOUR
    want = window_counts(whole, ["trial_id"], "ms", HOUR, 24 * HOUR).where(
        F.col("window_start_ms") + HOUR <= late).select(
        "trial_id", "window_start_ms", "n_rows", "running_total")
    assert got == sorted(map(tuple, want.collect()))


def test_late_rows_change_no_closed_total(spark):
    src, sink, ck = (scratch_path(spark, n) for n in ("lt-src", "lt-sink", "lt-ck"))
    drop(spark, src, [("a", 1, 0, "s"), ("a", 2, 5 * HOUR, "s")])
    total = lambda: running_total(stream(spark, src), "trial_id", "ts", "1 hour", "0 seconds")
    run_stateful(total(), sink, ck)
    drop(spark, src, [("a", 3, 1, "s"), ("a", 4, 9 * HOUR, "s")])
    run_stateful(total(), sink, ck)
    assert sorted((r.window_start_ms, r.running_total) for r in
                  spark.read.parquet(sink).collect()) == [(0, 1), (5 * HOUR, 2)]


@pytest.mark.parametrize("width", [3 * HOUR])
def test_live_sessions_equal_the_batch_join_when_all_has_come(spark, width):
    """Overlapping, equal, nested and empty sessions; a third of the rows in one trial.
    The last files close all buckets before them."""
    a, b, sink, ck = (scratch_path(spark, n) for n in ("ls-a", "ls-b", "ls-sink", "ls-ck"))
    rng = random.Random(5)
    longest = 4 * HOUR
    big = 1 << 60  # ids that a double can't hold
    starts, samples = [], []
    for part in range(2):
        lo = part * 30 * HOUR
        starts += [(rng.choice("aabc"), big + 100 * part + i, lo + rng.randrange(40) * HOUR // 2,
                    str(rng.choice([0, 1, HOUR, longest]))) for i in range(30)]
        samples += [(rng.choice("aabd"), big + 1000 * part + i, lo + rng.randrange(40) * HOUR // 2, "s")
                    for i in range(80)]
    odd = [(None, 1, 5, "0"), ("a", None, 5, "0"), ("a", 3, None, "0")]

    def run():
        s = stream(spark, b).select("trial_id", F.col("id").alias("session_id"),
                                    F.col("ts").alias("start"), F.timestamp_millis(
                                        F.col("ms") + F.col("kind").cast("long")).alias("end"))
        x = stream(spark, a).select("trial_id", F.col("id").alias("sample_id"), "ts")
        run_stateful(live_sessions(x, s, "trial_id", "ts", "sample_id", "start", "end",
                                   "session_id", "1 hour", longest, width), sink, ck)
        return sorted(map(tuple, spark.read.parquet(sink).collect()))
    sizes = []
    for part in range(2):
        drop(spark, a, [r for r in samples if r[2] // (30 * HOUR) == part] + odd)
        drop(spark, b, [r for r in starts if r[2] // (30 * HOUR) == part] + odd)
        sizes.append(len(run()))
    for path in (a, b):
        drop(spark, path, [("z", 1, 1000 * HOUR, "0")])
    got = run()
    assert 0 < sizes[0] < sizes[1] <= len(got)
    ses = spark.createDataFrame(starts, EVENT).select(
        "trial_id", F.col("id").alias("session_id"), F.col("ms").alias("start_ms"),
        (F.col("ms") + F.col("kind").cast("long")).alias("end_ms"))
    smp = spark.createDataFrame(samples, EVENT).select("trial_id", F.col("id").alias("sample_id"), "ms")
    want = active_session(smp, ses, ["trial_id"], "ms", "start_ms", "end_ms", 24 * HOUR,
                          "session_id", tiebreak=["sample_id"])
    assert got == sorted(map(tuple, want.select("trial_id", "session_id", "sample_id").collect()))


def test_sessions_of_many_keys_share_groups(spark):
    """A group is a slot of keys, not a key: 300 keys make few groups, each key its own rows."""
    src, sink, ck = (scratch_path(spark, n) for n in ("sl-src", "sl-sink", "sl-ck"))
    rows = [(f"k{k}", 10 * k + j, 1000 * j + k, "start" if j in (1, 3) else "s")
            for k in range(300) for j in range(5)]
    drop(spark, src, rows + [("end", 9998, 9 * HOUR, "s"), ("end", 9999, 9 * HOUR, "start")])
    ev = stream(spark, src)
    starts = ev.where("kind = 'start'").select(
        "trial_id", F.col("id").alias("session_id"), F.col("ts").alias("start"),
        F.timestamp_millis(F.col("ms") + 1500).alias("end"))
    samples = ev.where("kind = 's'").select("trial_id", F.col("id").alias("sample_id"), "ts")
    run_stateful(live_sessions(samples, starts, "trial_id", "ts", "sample_id", "start", "end",
                               "session_id", "0 seconds", HOUR, HOUR, slots=3), sink, ck)
    got = {tuple(r) for r in spark.read.parquet(sink).where("trial_id <> 'end'").collect()}
    assert got == {(f"k{k}", 10 * k + j - 1, 10 * k + j) for k in range(300) for j in (2, 4)}
