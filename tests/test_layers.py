"""FIXTURES B5: incremental layers, sources, streaming, inference."""

import os

import pytest
from pyspark.sql import functions as F

from stridelake.operators.inference import detect_landmarks, stub_detector_factory
from stridelake.plans.layers import read_layer, run_layer
from stridelake.session import scratch_path
from stridelake.sources.files import IMU_SCHEMA, parse_imu_lines, read_frames, read_imu_csv
from stridelake.streaming.ingest import ingest_files

CSV_HEADER = ("host_timestamp_ms,imu_timestamp_ms,accel_x_g,accel_y_g,accel_z_g,"
              "gyro_x_dps,gyro_y_dps,gyro_z_dps\n")


def write_csv(root, trial, name, rows):
    d = os.path.join(root, f"trial_id={trial}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(CSV_HEADER + "".join(",".join(map(str, r)) + "\n" for r in rows))


def test_run_layer_is_incremental_and_idempotent(spark):
    src, tgt = scratch_path(spark, "src"), scratch_path(spark, "bronze")
    write_csv(src, "0001", "imu_a.csv", [(1000.5, 1, 0, 0, 1, 0, 0, 0), (1010.5, 2, 0, 0, 1, 0, 0, 0)])
    r1 = run_layer(spark, read_imu_csv(spark, src), lambda d: d, tgt, batch_id="1")
    assert r1.status == "written"
    r2 = run_layer(spark, read_imu_csv(spark, src), lambda d: d, tgt, batch_id="2")
    assert r2.status == "nothing_new"
    # a late file of a loaded trial is not loaded at trial level (D22)
    write_csv(src, "0001", "imu_b.csv", [(1020.5, 3, 0, 0, 1, 0, 0, 0)])
    assert run_layer(spark, read_imu_csv(spark, src), lambda d: d, tgt).status == "nothing_new"
    df = read_layer(spark, tgt)
    assert df.count() == 2
    assert {r.trial_id for r in df.select("trial_id").collect()} == {"0001"}  # stays a string
    # missing upstream: no-op
    assert run_layer(spark, None, lambda d: d, tgt).status == "missing_upstream"


def test_stream_ingest_picks_up_late_files(spark):
    src = scratch_path(spark, "stream-src")
    sink, ck = scratch_path(spark, "sink"), scratch_path(spark, "ck")
    write_csv(src, "7", "imu_a.csv", [(1.0, 1, 0, 0, 1, 0, 0, 0)])
    from stridelake.sources.files import IMU_SCHEMA
    assert ingest_files(spark, src, IMU_SCHEMA, sink, ck).count() == 1
    write_csv(src, "7", "imu_b.csv", [(2.0, 2, 0, 0, 1, 0, 0, 0)])
    assert ingest_files(spark, src, IMU_SCHEMA, sink, ck).count() == 2
    assert ingest_files(spark, src, IMU_SCHEMA, sink, ck).count() == 2  # exactly once


def test_frame_paths(spark):
    root = scratch_path(spark, "frames")
    for rel in ["trial_id=a/frame_0001700000000000.jpg", "trial_id=a/other.jpg", "x/frame_5.jpg"]:
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(b"\xff\xd8")
    got = sorted(((r.trial_id, r.frame_ts_ms) for r in read_frames(spark, root).collect()),
                 key=lambda x: (x[0], x[1] is not None, x[1] or 0))
    assert got == [("", 5), ("a", None), ("a", 1700000000000)]


def test_parse_lines(spark):
    lines = ["100,0.1,0.2,0.3,1.0,2.0,3.0", "bad", "1,2,3", "x,0.1,0.2,0.3,1,2,3",
             "  5,1,1,1,1,1,1  ", "1,2,3,4,5,6,7,8"]
    got = parse_imu_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(r.millis for r in got.collect()) == [5, 100]


def test_detector_errors_give_empty_lists(spark):
    frames = spark.createDataFrame(
        [("a", 1, bytearray(b"0.1,0.2,0.09")), ("a", 2, bytearray(b"\xff\xfe")),
         ("a", None, bytearray(b"0.1,0.2,0.3"))],
        "trial_id string, frame_ts_ms long, content binary")
    out = {r.frame_ts_ms: r.landmarks for r in
           detect_landmarks(frames, stub_detector_factory()).collect()}
    assert set(out) == {1, 2}  # null timestamp rejected before inference
    assert out[2] == []
    assert out[1][0].landmark_id == 23 and abs(out[1][0].visibility - 0.9) < 1e-6


def test_source_ids_and_names(spark):
    from stridelake.functions.scalar import chunk_file_name, frame_file_name
    from stridelake.sources.files import source_trial_ids
    root = scratch_path(spark, "ids")
    write_csv(root, "0007", "a.csv", [(1.0, 1, 0, 0, 1, 0, 0, 0)])
    write_csv(root, "x", "b.csv", [(1.0, 1, 0, 0, 1, 0, 0, 0)])
    assert sorted(r.trial_id for r in source_trial_ids(spark, root).collect()) == ["0007", "x"]
    r = spark.range(1).select(frame_file_name(F.lit(1700000000000)).alias("f"),
                              chunk_file_name(F.lit(1700000000000), F.lit(3)).alias("c")).first()
    assert (r.f, r.c) == ("frame_0001700000000000.jpg", "imu_0001700000000000_chunk0003.csv")


def test_raw_lines_stream_equals_batch(spark):
    from stridelake.sources.files import read_raw_lines
    from stridelake.streaming.ingest import run_available
    src = scratch_path(spark, "lines")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("100,0.1,0.2,0.3,1.0,2.0,3.0\nbad line\n101,1,1,1,1,1,x\n102,1,1,1,1,1,1\n")
    sink = scratch_path(spark, "lines-sink")
    run_available(read_raw_lines(spark, src, streaming=True), sink, scratch_path(spark, "ck"))
    streamed = sorted(spark.read.parquet(sink).collect())
    assert streamed == sorted(read_raw_lines(spark, src).collect())
    assert [r.millis for r in streamed] == [100, 102]


def test_stream_rate_complete_equals_batch_and_append_closed(spark):
    from stridelake.operators.signals import window_counts
    from stridelake.streaming.ingest import rate_per_window, run_available
    src = scratch_path(spark, "rate-src")
    rows = [("a", t) for t in range(0, 5 * 3_600_000, 700_000)] + \
           [("b", t) for t in range(1_000_000, 3 * 3_600_000, 1_300_000)]
    spark.createDataFrame(rows, "trial_id string, ms long").write.option("header", True) \
        .partitionBy("trial_id").csv(src)
    schema = "ms long, trial_id string"

    def stream():
        return (spark.readStream.schema(schema).option("header", True).csv(src)
                .withColumn("ts", F.timestamp_millis("ms")))

    batch = {(r.trial_id, r.window_start_ms): r.n_rows for r in window_counts(
        spark.read.schema(schema).option("header", True).csv(src), ["trial_id"], "ms",
        3_600_000, 6 * 3_600_000).collect()}
    name = "rate_complete_test"
    q = (rate_per_window(stream(), "trial_id", "ts", "1 hour", "1 hour").writeStream
         .format("memory").queryName(name).outputMode("complete")
         .option("checkpointLocation", scratch_path(spark, "ck")).trigger(availableNow=True)
         .start())
    q.awaitTermination()
    complete = {(r.trial_id, r.ms): r.n_rows for r in spark.sql(
        f"SELECT trial_id, unix_millis(window_start) AS ms, n_rows FROM {name}").collect()}
    assert complete == batch
    sink = scratch_path(spark, "rate-append")
    run_available(rate_per_window(stream(), "trial_id", "ts", "1 hour", "1 hour"), sink,
                  scratch_path(spark, "ck"))
    appended = {(r.trial_id, r.ms): r.n_rows for r in spark.read.parquet(sink).select(
        "trial_id", F.unix_millis("window_start").alias("ms"), "n_rows").collect()}
    watermark = max(t for _, t in rows) - 3_600_000
    assert appended == {k: v for k, v in batch.items() if k[1] + 3_600_000 <= watermark}


def test_pending_report(spark):
    from stridelake.plans.layers import pending_report
    done = scratch_path(spark, "results")
    spark.createDataFrame([("a",), ("b",)], "trial_id string").write.parquet(done)
    cam = spark.createDataFrame([("a",), ("c",), ("c",)], "trial_id string")
    imu = spark.createDataFrame([("b",), ("c",), ("d",)], "trial_id string")
    rep = [(r.trial_id, r.reason) for r in
           pending_report(spark, {"camera": cam, "imu": imu}, done).collect()]
    assert rep == [("c", "not_processed"), ("d", "no_camera")]
    # nothing finished yet: everything from the sources is pending
    rep2 = pending_report(spark, {"camera": cam, "imu": imu}, scratch_path(spark, "none"))
    assert [r.trial_id for r in rep2.collect()] == ["a", "b", "c", "d"]


def test_reused_batch_id_keeps_loaded_trials(spark):
    tgt = scratch_path(spark, "reuse")
    ab = spark.createDataFrame([("A", 1), ("B", 2)], "trial_id string, v int")
    abc = ab.union(spark.createDataFrame([("C", 3)], "trial_id string, v int"))
    assert run_layer(spark, ab, lambda d: d, tgt, batch_id="day1").status == "written"
    assert run_layer(spark, abc, lambda d: d, tgt, batch_id="day1").status == "written"
    assert run_layer(spark, abc, lambda d: d, tgt).status == "nothing_new"  # default id
    got = sorted((r.trial_id, r.v, r.batch_id) for r in read_layer(spark, tgt).collect())
    assert got == [("A", 1, "day1"), ("B", 2, "day1"), ("C", 3, "day1")]


def test_two_runs_in_one_second(spark):
    tgt = scratch_path(spark, "fast")
    for k in "AB":
        run_layer(spark, spark.createDataFrame([(k,)], "trial_id string"), lambda d: d, tgt)
    assert sorted(r.trial_id for r in read_layer(spark, tgt).collect()) == ["A", "B"]


def test_failed_run_leaves_nothing_visible(spark):
    import pytest
    tgt = scratch_path(spark, "failed")
    one = spark.createDataFrame([("A", 1)], "trial_id string, v int")
    run_layer(spark, one, lambda d: d, tgt, batch_id="x")
    two = one.union(spark.createDataFrame([("B", 0)], "trial_id string, v int"))
    with pytest.raises(Exception):
        run_layer(spark, two, lambda d: d.withColumn("v", F.raise_error(F.lit("no"))), tgt,
                  batch_id="x")
    assert read_layer(spark, tgt).count() == 1
    assert run_layer(spark, two, lambda d: d, tgt, batch_id="x").status == "written"
    assert sorted(r.trial_id for r in read_layer(spark, tgt).collect()) == ["A", "B"]


def test_new_rows_are_found_on_keys_alone(spark):
    """The upstream's other columns are read once, for the write."""
    from pyspark.sql import functions as G
    tgt, src = scratch_path(spark, "keys"), scratch_path(spark, "keys-src")
    spark.range(100).select(G.col("id").cast("string").alias("trial_id"),
                            G.lit(b"x" * 100).alias("content")).write.parquet(src)
    up = spark.read.parquet(src)
    run_layer(spark, up.where("trial_id < '5'"), lambda d: d, tgt)
    seen = []
    run_layer(spark, up, lambda d: seen.append(
        d._jdf.queryExecution().executedPlan().toString()) or d, tgt)
    assert "LeftSemi" in seen[0] and "Exchange hashpartitioning" not in seen[0]
    assert read_layer(spark, tgt).count() == 100


def test_rejected_lines_and_frames(spark):
    from stridelake.operators.inference import rejected_frames
    from stridelake.sources.files import rejected_imu_lines
    lines = ["100,0.1,0.2,0.3,1.0,2.0,3.0", "bad", "x,0.1,0.2,0.3,1,2,3", "1,2,3,4,5,6,z",
             "1,2,3,4,5,6,7,8", "  5,1,1,1,1,1,1  ", None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r.value: r.reason for r in rejected_imu_lines(df).collect()}
    assert got == {"bad": "fields", "x,0.1,0.2,0.3,1,2,3": "number", "1,2,3,4,5,6,z": "number",
                   "1,2,3,4,5,6,7,8": "fields", None: "fields"}
    assert parse_imu_lines(df).count() + len(got) == len(lines)
    f = spark.createDataFrame([("a", 1), ("b", None)], "trial_id string, frame_ts_ms long")
    assert [(r.trial_id, r.reason) for r in rejected_frames(f).collect()] == [("b", "no_time")]


def test_a_half_published_run_is_not_read(spark, monkeypatch):
    """The move breaks after some files, or the marker is missing: readers see nothing
    of the run, and the next one loads its trials."""
    from stridelake.plans import layers
    tgt = scratch_path(spark, "half")
    df = spark.createDataFrame([("A", 1), ("B", 2)], "trial_id string, v int").repartition(2)
    assert run_layer(spark, df.where("trial_id = 'A'"), lambda d: d, tgt).status == "written"
    plain = layers.move

    def breaks(spark, source, target):
        plain(spark, source, target)
        part = next(f for f in os.listdir(target) if f.startswith("part-"))
        with open(os.path.join(target, part), "wb") as f:
            f.write(b"PAR1 and no more")
        raise OSError("lost in the middle")
    monkeypatch.setattr(layers, "move", breaks)
    with pytest.raises(OSError):
        run_layer(spark, df, lambda d: d, tgt)
    monkeypatch.setattr(layers, "move", plain)
    assert [r.trial_id for r in read_layer(spark, tgt).collect()] == ["A"]
    assert [r.trial_id for r in layers.loaded_keys(spark, tgt).collect()] == ["A"]
    assert run_layer(spark, df, lambda d: d, tgt).status == "written"
    assert sorted((r.trial_id, r.v) for r in read_layer(spark, tgt).collect()) == [("A", 1), ("B", 2)]
    assert run_layer(spark, df, lambda d: d, tgt).status == "nothing_new"


def test_keys_come_from_key_tables(spark):
    """The set of loaded keys reads no file of the layer's rows."""
    from stridelake.plans import layers
    tgt = scratch_path(spark, "keyed")
    for t in "AB":
        df = spark.range(50).select(F.lit(t).alias("trial_id"), F.col("id").alias("v"))
        run_layer(spark, df, lambda d: d, tgt)
    keys = layers.loaded_keys(spark, tgt)
    assert sorted(r.trial_id for r in keys.collect()) == ["A", "B"]
    assert all("/_keys/" in f for f in keys.inputFiles())
    assert layers.loaded_keys(spark, scratch_path(spark, "absent")) is None


def test_lines_stream_to_two_tables_once(spark):
    """Files come in two drops; the last batch is done again after its commit is lost."""
    from stridelake.streaming.ingest import ingest_lines
    src = scratch_path(spark, "lines")
    good, bad, ck = (scratch_path(spark, n) for n in ("good", "bad", "lines-ck"))
    os.makedirs(src)

    def drop(name, lines):
        with open(os.path.join(src, name), "w") as f:
            f.write("".join(x + "\n" for x in lines))
    empty = ingest_lines(spark, src, good, bad, ck)
    assert [t.count() for t in empty] == [0, 0]
    drop("a.txt", ["1,0,0,1,0,0,0", "1,2", "", "x,0,0,1,0,0,0"])
    a, b = ingest_lines(spark, src, good, bad, ck)
    assert [r.millis for r in a.collect()] == [1]
    assert sorted((r.value, r.reason) for r in b.collect()) == [
        ("", "fields"), ("1,2", "fields"), ("x,0,0,1,0,0,0", "number")]
    drop("b.txt", ["2,0,0,1,0,0,0", "3,0,0,1,0,0,nope"])
    for _ in range(2):
        a, b = ingest_lines(spark, src, good, bad, ck)
        assert sorted(r.millis for r in a.collect()) == [1, 2] and b.count() == 4
        commits = os.path.join(ck, "commits")
        last = max(int(f) for f in os.listdir(commits) if f.isdigit())
        for f in (str(last), f".{last}.crc"):
            if os.path.exists(os.path.join(commits, f)):
                os.remove(os.path.join(commits, f))


def test_batches_of_frames_are_bounded_and_failures_are_data(spark):
    from stridelake.operators.inference import (detect_batches, failed_frames, in_batches,
                                                one_by_one)
    cuts = [(s.start, s.stop) for s in in_batches([3, 3, 9, 1, 1, 1, 1], 3, 6)]
    assert cuts == [(0, 2), (2, 3), (3, 6), (6, 7)]
    assert list(in_batches([], 3, 6)) == []
    good = ",".join(["0.1"] * 3).encode()
    rows = [("a", i, good) for i in range(20)] + [
        ("a", 100, b"\xff\xfe"), ("a", 101, b"x"), ("b", 102, None), ("b", 102, None),
        ("b", 103, b""), ("c", None, good), (None, 104, good)]
    frames = spark.createDataFrame([(k, t, None if c is None else bytearray(c)) for k, t, c in rows],
                                   "trial_id string, frame_ts_ms long, content binary").coalesce(1)
    out = detect_batches(frames, one_by_one(stub_detector_factory()), model="stub", batch_frames=8)
    got = out.collect()
    assert len(got) == 26 and sum(len(r.landmarks) for r in got) == 21
    assert all((r.reason is None) == (len(r.landmarks) == 1) for r in got)
    assert sorted((r.trial_id, r.frame_ts_ms, r.reason) for r in failed_frames(out).collect()) == [
        ("a", 100, "UnicodeDecodeError"), ("a", 101, "ValueError"), ("b", 102, "no_content"),
        ("b", 102, "no_content"), ("b", 103, "ValueError")]
    from stridelake.operators.inference import loaded
    made = []
    for name in ("m", "m", None):
        loaded(name, lambda: made.append(1) or list)
    assert len(made) == 2
    assert detect_batches(frames.limit(0), one_by_one(stub_detector_factory())).count() == 0
    short = detect_batches(frames.where("frame_ts_ms < 3"), lambda: lambda some: some[1:])
    assert {r.reason for r in short.collect()} == {"ValueError"}


def test_reads_go_to_the_runs_of_the_keys(spark):
    """A step over a layer, and a read by keys, open only the runs that hold the keys."""
    from stridelake.plans.layers import LayerSource, runs_with
    up, tgt = scratch_path(spark, "runs-up"), scratch_path(spark, "runs-tgt")
    df = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3), (None, 4)], "trial_id string, v int")
    assert run_layer(spark, LayerSource(up), lambda d: d, tgt).status == "missing_upstream"
    for i, some in enumerate([["A", "B"], ["A", "B", "C"]]):
        assert run_layer(spark, df.where(F.col("trial_id").isin(some)), lambda d: d, up,
                         batch_id=str(i)).status == "written"
    seen = []

    def keep(d):
        seen.append(d.inputFiles())
        return d
    key = lambda *x: spark.createDataFrame([(k,) for k in x], "trial_id string")
    assert [r.split("/")[0] for r in runs_with(spark, up, key("C", "nobody", None))] == ["batch_id=1"]
    assert all("/batch_id=1/" in f for f in read_layer(spark, up, keys=key("C")).inputFiles())
    none = read_layer(spark, up, keys=key("nobody"))
    assert none.count() == 0 and none.columns == ["trial_id", "v", "batch_id"]
    run_layer(spark, df.where("trial_id = 'A'"), lambda d: d, tgt)
    assert run_layer(spark, LayerSource(up), keep, tgt).status == "written"
    run_layer(spark, df.where("trial_id is null"), lambda d: d, up)  # no key: not loaded again
    run_layer(spark, df.selectExpr("'D' trial_id", "v").limit(1), lambda d: d, up, batch_id="2")
    assert run_layer(spark, LayerSource(up), keep, tgt).status == "written"
    assert seen[1] and all("/batch_id=2/" in f for f in seen[1] if up in f)
    assert sorted(r.trial_id for r in read_layer(spark, tgt).collect()) == ["A", "B", "C", "D"]
    assert run_layer(spark, LayerSource(up), keep, tgt).status == "nothing_new"


def test_late_files_replace_their_trials(spark, monkeypatch):
    """Files of a loaded trial come later, one repeats rows, and a batch is done again."""
    from stridelake.plans import chains
    from stridelake.plans.layers import read_latest
    p = chains.Paths(*[scratch_path(spark, f"lf-{i}") for i in range(8)])
    ck = scratch_path(spark, "lf-ck")
    os.makedirs(p.imu_source)

    def rows(*ms):
        return [(m, m, 0.1, 0.2, 0.9, 1, 2, m) for m in ms]
    write = lambda trial, name, ms: write_csv(p.imu_source, trial, name, rows(*ms))
    write("A", "a.csv", [10, 20])
    write("B", "a.csv", [10])
    silver = chains.imu_file_chain(spark, p, ck)
    first = sorted((r.trial_id, r.imu_timestamp_ms) for r in silver.collect())
    assert first == [("A", 10), ("A", 20), ("B", 10)]
    write("A", "late.csv", [20, 5])  # 20 is there already
    write("C", "a.csv", [7])
    real = chains.publish

    def breaks(df, target, *a, **k):
        if target == p.silver_imu:
            raise OSError("lost in the middle")
        real(df, target, *a, **k)
    monkeypatch.setattr(chains, "publish", breaks)
    with pytest.raises(Exception, match="lost in the middle"):
        chains.imu_file_chain(spark, p, ck)
    got = lambda: sorted((r.trial_id, r.imu_timestamp_ms) for r in
                         read_latest(spark, p.silver_imu).collect())
    assert got() == first
    monkeypatch.setattr(chains, "publish", real)
    for _ in range(2):
        chains.imu_file_chain(spark, p, ck, max_files_per_trigger=1)
        assert got() == [("A", 5), ("A", 10), ("A", 20), ("B", 10), ("C", 7)]
    assert read_latest(spark, scratch_path(spark, "absent")) is None


def test_file_chain_holds_no_list_of_files_on_the_driver(spark):
    """The stream's own log, which the driver holds, does not grow with the source's files."""
    from stridelake.plans import chains
    p = chains.Paths(*[scratch_path(spark, f"many-{i}") for i in range(8)])
    ck = scratch_path(spark, "many-ck")
    os.makedirs(p.imu_source)
    assert chains.imu_file_chain(spark, p, ck) is None  # no file yet
    for drop in ("a", "b"):
        for i in range(60):
            write_csv(p.imu_source, i, f"{drop}.csv", [(ord(drop), i, 0.1, 0.2, 0.9, 1, 2, 3)])
        silver = chains.imu_file_chain(spark, p, ck)
    assert silver.count() == 120
    logs = [os.path.join(d, f) for d, _, fs in os.walk(ck) if "/sources/" in d for f in fs
            if not f.endswith(".crc")]
    assert logs and sum(open(f).read().count('"path"') for f in logs) < 60


def test_file_chain_goes_on_with_a_checkpoint_of_sparks_file_stream(spark, monkeypatch):
    from stridelake.plans import chains
    p = chains.Paths(*[scratch_path(spark, f"old-{i}") for i in range(8)])
    ck = scratch_path(spark, "old-ck")
    write_csv(p.imu_source, "A", "a.csv", [(10, 10, 0, 0, 1, 0, 0, 0)])
    with monkeypatch.context() as m:
        m.setattr(chains, "arrow_reads", lambda *_: False)
        chains.imu_file_chain(spark, p, ck)
    write_csv(p.imu_source, "A", "b.csv", [(20, 20, 0, 0, 1, 0, 0, 0)])
    assert chains.imu_file_chain(spark, p, ck).count() == 2
    assert read_layer(spark, p.bronze_imu).count() == 2  # no file twice


def test_new_files_are_streamed_once_the_oldest_first(spark):
    from stridelake.streaming.ingest import new_files, run_batches
    src, known, ck = (scratch_path(spark, f"new-{i}") for i in "skc")
    got = []

    def run():
        run_batches(new_files(spark, src, known, 2),
                    lambda d, _: got.append(sorted(r.path for r in d.collect())), ck)
    for i, name in enumerate("cabde"):
        write_csv(src, name, "x.csv", [])
        os.utime(os.path.join(src, f"trial_id={name}", "x.csv"), (1000 + i, 1000 + i))
    for hidden in ("_tmp.csv", ".x.csv", "y.csv._COPYING_", "_temporary/0/z.csv"):
        f = os.path.join(src, "trial_id=a", hidden)
        os.makedirs(os.path.dirname(f), exist_ok=True)
        open(f, "w").close()
    run()
    assert sum(got, []) and sorted(map(len, got)) == [1, 2, 2]
    assert {"trial_id=a/x.csv", "trial_id=c/x.csv"} == set(got[0])
    run()
    assert len(got) == 3  # nothing new
    write_csv(src, "a", "late.csv", [])
    run()
    assert got[3:] == [["trial_id=a/late.csv"]]
    with pytest.raises(Exception, match="new-absent"):
        new_files(spark, scratch_path(spark, "new-absent"), known)


@pytest.mark.parametrize("block", [1, 3, 64])
def test_parts_of_a_file_have_each_line_once(monkeypatch, block):
    import io

    from stridelake.sources import files
    monkeypatch.setattr(files, "BLOCK_BYTES", block)
    for text in (b"", b"a", b"a\n", b"\n\na\nbb\n\nccc", b"a\r\nbb\r\n", b"a\rbb\rccc\r", b"aaaaaaaaaa\nb"):
        for size in range(1, len(text) + 2):
            got = [x for at in range(0, max(len(text), 1), size)
                   for piece in files.whole_lines(io.BytesIO(text), at, at + size)
                   for x in piece.replace(b"\r", b"\n").split(b"\n") if x]
            assert got == [x for x in text.replace(b"\r", b"\n").split(b"\n") if x]
        assert b"".join(files.whole_lines(io.BytesIO(text), 0, None)) == text


@pytest.mark.parametrize("part", [32 << 20, 40])
def test_files_opened_by_tasks_read_as_sparks_reader_has_them(spark, monkeypatch, part):
    import gzip

    from stridelake.sources import files
    monkeypatch.setattr(files, "READ_BYTES", part)
    monkeypatch.setattr(files, "OPEN_BYTES", min(part, files.OPEN_BYTES))
    src = scratch_path(spark, "odd-csv")
    row = "10.5,7,0.1,0.2,0.9,1,2,3\n"
    odd = {
        "trial_id=A/plain.csv": CSV_HEADER + row * 30, "trial_id=A/no-end.csv": CSV_HEADER + row[:-1],
        "trial_id=B/crlf.csv": (CSV_HEADER + row * 3).replace("\n", "\r\n"),
        "trial_id=B/cr.csv": (CSV_HEADER + row * 3).replace("\n", "\r"),
        "trial_id=0001/bad.csv": CSV_HEADER + "x,7,0.1,,0.9,NaN,Infinity,3\n1,2\n" + row[:-1] + ",9,9\n"
        + "1,2.5,3,4,5,6,7,8\n\n \t\n,,,,,,,\n\"1\",\"2\",\"3\",4,5,6,7,\"8\n",
        "trial_id=a%3Ab%zz/bom.csv": "\ufeff\n" + CSV_HEADER + row, "trial_id=é/x.csv": CSV_HEADER + row,
        "trial_id=__HIVE_DEFAULT_PARTITION__/null.csv": CSV_HEADER + row * 2,
        "trial_id=E/header.csv": CSV_HEADER, "trial_id=E/empty.csv": "", "trial_id=E/_no.csv": row,
        "trial_id=E/f.csv.gz": CSV_HEADER + row * 9,
    }
    for name, text in odd.items():
        f = os.path.join(src, name)
        os.makedirs(os.path.dirname(f), exist_ok=True)
        with (gzip.open if name.endswith(".gz") else open)(f, "wb") as out:
            out.write(text.encode())
    assert files.arrow_reads(spark, src)
    assert not files.arrow_reads(spark, f"{src}/trial_id=*")
    got = files.read_imu_files(files.list_files(spark, src), src)
    want = read_imu_csv(spark, src)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

    flat = scratch_path(spark, "flat-csv")  # the trial as a column
    os.makedirs(flat)
    with open(os.path.join(flat, "x.csv"), "w") as out:
        out.write(CSV_HEADER + row[:-1] + ",T\n" + row[:-1] + ",\n" + row)
    got = files.read_imu_files(files.list_files(spark, flat), flat)
    assert sorted(map(str, got.collect())) == sorted(map(str, read_imu_csv(spark, flat).collect()))
    with open(os.path.join(flat, "x.csv.snappy"), "w") as out:
        out.write("?")
    with pytest.raises(Exception, match="not readable: x.csv.snappy"):
        files.read_imu_files(files.list_files(spark, flat), flat).collect()


def test_trial_csv_has_a_file_a_trial_and_several_for_a_long_one(spark):
    from stridelake.sources.files import source_trial_ids, write_trial_csv
    path = scratch_path(spark, "trial-csv")
    rows = [(float(i), i, 1.5, None, float("nan"), 0.0, 0.0, 0.0, t)
            for t, n in (("a", 3), ("b", 90), (None, 2)) for i in range(n)]
    d = spark.createDataFrame(rows, IMU_SCHEMA).repartition(8)
    write_trial_csv(d, path, rows_per_file=30)
    back = read_imu_csv(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, d.collect()))
    files = {t: len(os.listdir(os.path.join(path, t))) for t in os.listdir(path)}
    assert files["trial_id=a"] == 1 and 2 <= files["trial_id=b"] <= 3
    write_trial_csv(d.where("trial_id = 'a'"), path)  # added to what is there
    assert read_imu_csv(spark, path).where("trial_id = 'a'").count() == 6
    assert {"a", "b"} <= {r.trial_id for r in source_trial_ids(spark, path).collect()}


def test_exported_events_are_files_of_many_trials(spark, tmp_path):
    from stridelake.plans import catalogue
    (spark.range(400).selectExpr("id event_id", "timestamp_millis(id * 1000) ts", "id user_id",
                                 "'view' event_type", "1.0D value").coalesce(2)
     .write.parquet(str(tmp_path / "events.parquet")))
    out = catalogue._export_events_csv(spark, str(tmp_path))
    n = sum(f.endswith(".csv") for _, _, fs in os.walk(out) for f in fs)
    assert n <= 8
    back = spark.read.schema(catalogue.EV_CSV_SCHEMA).option("header", True).csv(out)
    assert back.count() == 400 and back.select("trial_id").distinct().count() == 400
