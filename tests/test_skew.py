"""One hot trial is spread over many tasks, and results stay exact."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stridelake.operators import signals
from stridelake.operators.sequence import range_frame, scan
from stridelake.operators.signals import min_spacing


@pytest.fixture(autouse=True)
def no_coalescing(spark):
    """Small test data would be merged into one partition by AQE; turn that
    off to see how the plan itself spreads a hot key."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def hot(spark, n=60_000):
    # one trial at 100 Hz (10 ms) plus a few small ones
    big = spark.range(n).select(F.lit("hot").alias("k"), (F.col("id") * 10).alias("ts"),
                                (F.col("id") % 7 == 0).alias("s"))
    small = spark.range(300).select(F.concat(F.lit("t"), (F.col("id") % 3).cast("string"))
                                    .alias("k"), (F.col("id") * 10).alias("ts"),
                                    (F.col("id") % 2 == 0).alias("s"))
    return big.unionByName(small)


def test_hot_trial_scan_uses_many_tasks(spark):
    df = hot(spark)
    out = scan(df, ["k"], "ts", 20_000, runs=["s"], cumsum=["ts"])
    spread = (out.filter(F.col("k") == "hot").select(F.spark_partition_id().alias("p"))
                 .distinct().count())
    assert spread > 1
    w = Window.partitionBy("k").orderBy("ts")
    ref = df.withColumn("cum_ts", F.sum("ts").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    a = out.select("k", "ts", "cum_ts").exceptAll(ref.select("k", "ts", "cum_ts"))
    assert a.isEmpty()
    runs = out.filter(F.col("k") == "hot").agg(F.max("run_s")).first()[0]
    vals = [i % 7 == 0 for i in range(60_000)]
    assert runs == 1 + sum(1 for a, b in zip(vals, vals[1:]) if a != b)


def test_hot_trial_range_frame_uses_many_tasks(spark):
    df = hot(spark)
    out = range_frame(df, ["k"], "ts", -499, 500, 20_000, {"m": F.avg(F.col("s").cast("int"))})
    spread = (out.filter(F.col("k") == "hot").select(F.spark_partition_id().alias("p"))
                 .distinct().count())
    assert spread > 1
    w = Window.partitionBy("k").orderBy("ts").rangeBetween(-499, 500)
    ref = df.select("k", "ts", F.avg(F.col("s").cast("int")).over(w).alias("m"))
    assert out.select("k", "ts", "m").exceptAll(ref).isEmpty()
    assert out.count() == df.count()


def _walk(times, gap):
    kept = []
    for t in sorted(times):
        if not kept or t >= kept[-1] + gap:
            kept.append(t)
    return kept


def test_composed_walks_equal_the_walk(spark, monkeypatch):
    """Runs of three buckets, so that a key has several levels; gaps in time, bursts,
    repeated times, a key of one row, and times before the epoch."""
    monkeypatch.setattr(signals, "WALK_RUN", 3)
    rnd = random.Random(3)
    times = {"one": [5], "sparse": [-10_000 + 377 * i for i in range(90)],
             "dense": [rnd.randrange(-500, 4000) for _ in range(3000)],
             "bursts": [1000 * rnd.randrange(12) + rnd.randrange(25) for _ in range(400)]}
    df = spark.createDataFrame([(k, t, i) for k, ts in times.items() for i, t in enumerate(ts)],
                               "k string, t long, i long")
    for gap in (7, 10, 40):
        got = {}
        for r in min_spacing(df, ["k"], "t", gap, tiebreak=["i"]).collect():
            got.setdefault(r.k, []).append(r.t)
        assert {k: sorted(v) for k, v in got.items()} == {k: _walk(v, gap) for k, v in times.items()}


def test_no_task_follows_all_buckets_of_a_key(spark, monkeypatch):
    """40,000 buckets of one key: a run holds at most WALK_RUN of them, and the walk
    is followed over as many runs at most."""
    written, plain = [], signals.cut

    def watched(df, name):
        written.append(plain(df, name))
        return written[-1]
    monkeypatch.setattr(signals, "cut", watched)
    df = spark.range(160_000).select(F.lit("hot").alias("k"), (F.col("id") * 10).alias("t"))
    assert min_spacing(df, ["k"], "t", 10).count() == 160_000
    rows = [d.count() for d in written]
    assert rows == [40_000, 79]  # 40,000 / 512
    assert signals.WALK_RUN == 512 and signals._most_rows(written[-1], ["k"]) <= 512
