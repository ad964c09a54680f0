"""Bucketed scans and halo range frames equal plain per-key windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from stridelake.operators.sequence import frame_sums, range_frame, scan


def _data(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for k in range(6):
        t = 0
        for i in range(rnd.randint(0, 70)):
            t += rnd.choice([1, 2, 3, 7, 20, 50, 120])
            rows.append((k, t, i, rnd.choice([None, 0, 1, 1, 2]), rnd.random() < 0.5))
    return spark.createDataFrame(rows, "k long, ts long, id long, v long, s boolean")


def test_scan_matches_windows(spark):
    for seed, width in [(1, 25), (2, 7), (3, 1000)]:
        df = _data(spark, seed)
        out = scan(df, ["k"], "ts", width, tiebreak=["id"], lag=["v"], lead=["v"],
                   cumsum=["v"], ffill=["v"], bfill=["v"], runs=["s"])
        w = Window.partitionBy("k").orderBy("ts", "id")
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        chg = F.lag("s").over(w).isNull() | (F.lag("s").over(w) != F.col("s"))
        ref = (df.withColumn("prev_v", F.lag("v").over(w))
                 .withColumn("next_v", F.lead("v").over(w))
                 .withColumn("cum_v", F.coalesce(F.sum("v").over(upto), F.lit(0)))
                 .withColumn("ffill_v", F.last("v", True).over(upto))
                 .withColumn("bfill_v", F.first("v", True).over(
                     w.rowsBetween(0, Window.unboundedFollowing)))
                 .withColumn("_c", chg.cast("int"))
                 .withColumn("run_s", F.sum("_c").over(upto))
                 .withColumn("start_s", F.col("_c") == 1))
        cols = ["k", "ts", "id", "prev_v", "next_v", "cum_v", "ffill_v", "bfill_v", "run_s",
                "start_s"]
        assert sorted(out.select(*cols).collect()) == sorted(ref.select(*cols).collect())


def test_range_frame_matches_window(spark):
    df = _data(spark, 4)
    got = range_frame(df, ["k"], "ts", -9, 10, 30,
                      {"m": F.avg(F.col("s").cast("int")), "n": F.count(F.lit(1))})
    w = Window.partitionBy("k").orderBy("ts").rangeBetween(-9, 10)
    ref = df.select("k", "ts", "id", F.avg(F.col("s").cast("int")).over(w).alias("m"),
                    F.count(F.lit(1)).over(w).alias("n"))
    assert sorted(got.select("k", "ts", "id", "m", "n").collect()) == sorted(ref.collect())


def test_one_hot_key_spreads_over_buckets(spark):
    """A single key is processed in many (key, bucket) groups, not one."""
    rows = [(1, t, t, t % 3) for t in range(0, 5000, 5)]
    df = spark.createDataFrame(rows, "k long, ts long, id long, v long")
    out = scan(df, ["k"], "ts", 500, tiebreak=["id"], cumsum=["v"])
    assert out.agg(F.max("cum_v")).first()[0] == sum(r[3] for r in rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_bkt" in plan


def test_range_frame_keeps_rows_without_time(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 0), ("a", 5, 1), ("a", 7, 0)],
                               "k string, ts long, v int")
    got = range_frame(df, ["k"], "ts", -2, 2, 10, {"m": F.avg("v"), "n": F.count(F.lit(1))})
    w = Window.partitionBy("k").orderBy("ts").rangeBetween(-2, 2)
    ref = df.select("k", "ts", "v", F.avg("v").over(w).alias("m"),
                    F.count(F.lit(1)).over(w).alias("n"))
    key = lambda r: (r.ts is not None, r.ts or 0, r.v)
    assert sorted(got.select("k", "ts", "v", "m", "n").collect(), key=key) == \
        sorted(ref.collect(), key=key)


def test_scan_keeps_rows_without_time(spark):
    df = spark.createDataFrame([("a", None, 1, 5), ("a", 3, 2, 1), ("a", 70, 3, None),
                                ("b", None, 4, None), ("b", None, 5, 2)],
                               "k string, ts long, id long, v long")
    out = scan(df, ["k"], "ts", 10, tiebreak=["id"], cumsum=["v"], lag=["v"], ffill=["v"],
               runs=["v"])
    w = Window.partitionBy("k").orderBy("ts", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    new = ~F.lag("v").over(w).eqNullSafe(F.col("v")) | (F.row_number().over(w) == 1)
    ref = (df.withColumn("cum_v", F.coalesce(F.sum("v").over(upto), F.lit(0)))
             .withColumn("prev_v", F.lag("v").over(w))
             .withColumn("ffill_v", F.last("v", True).over(upto))
             .withColumn("_n", new.cast("int")).withColumn("run_v", F.sum("_n").over(upto)))
    cols = ["id", "cum_v", "prev_v", "ffill_v", "run_v"]
    assert sorted(out.select(*cols).collect()) == sorted(ref.select(*cols).collect())


def test_frame_sums_match_window(spark):
    """Nulls, repeated times, rows without a time and frames beside their row."""
    df = _data(spark, 5)
    df = df.unionByName(df.where("id % 5 = 0").withColumn("id", F.col("id") + 1000)).unionByName(
        spark.createDataFrame([(0, None, 1, 3, True), (0, None, 2, None, False), (9, None, 1, 4, None)],
                              df.schema))
    for lower, upper, width in [(-9, 10, 30), (-40, -3, 50), (5, 60, 1000), (0, 0, 7)]:
        got = frame_sums(df, ["k"], "ts", lower, upper, width,
                         {"total": F.col("v"), "n": F.lit(1).cast("long")})
        w = Window.partitionBy("k").orderBy("ts").rangeBetween(lower, upper)
        ref = df.select(*df.columns, F.coalesce(F.sum("v").over(w), F.lit(0)).alias("total"),
                        F.count(F.lit(1)).over(w).alias("n"))
        assert got.columns == ref.columns and got.count() == ref.count()
        assert got.exceptAll(ref).isEmpty()


def test_frame_sums_take_linear_time(spark):
    """200,000 rows in one frame: a pass over every row's frame would touch 4 * 10^10."""
    df = spark.range(200_000).select(F.lit(1).alias("k"), F.col("id").alias("ts"))
    got = frame_sums(df, ["k"], "ts", -200_000, 200_000, 400_000, {"n": F.lit(1).cast("long")})
    assert got.agg(F.min("n"), F.max("n"), F.count("n")).first() == (200_000,) * 3


def test_frame_sums_shuffle_once(spark):
    df = _data(spark, 6)
    out = frame_sums(df, ["k"], "ts", -9, 10, 30, {"n": F.lit(1).cast("long")}, keep_bucket=True)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "_bkt" in out.columns and out.where("_bkt is null").isEmpty()


def test_frame_sums_of_no_rows(spark):
    df = _data(spark, 7).where("false")
    assert frame_sums(df, ["k"], "ts", -1, 1, 10, {"n": F.lit(1).cast("long")}).isEmpty()
