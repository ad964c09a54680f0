"""The query catalogue: each entry reads the benchmark tables through a
mapping (sources/tables.py) and runs one operator of the engine over the
whole tables. Keys match ``oracles.SQL``.

Mapping E uses day-scale constants: the events of a user span a month, so
the 1 s smoothing window becomes 24 h, and peaks need a value above 28.
Finished walks there last 25 to 29 days, so the frailty cut sits at 28 days
to keep both outcomes present.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import epoch_ms, seconds_to_ms, zero_pad
from ..operators import quality as Q
from ..operators import relations as R
from ..operators import signals as G
from ..operators import trials as T
from ..operators.pose import pose_features
from ..operators.sequence import scan
from ..params import PoseParams, StepParams, TrialParams
from ..session import cut
from ..sources import tables as S
from . import reports as P

DAY_MS = 86_400_000
E_TRIAL = TrialParams(dwell_ms=DAY_MS, frail_s=28 * 86_400.0, bucket_ms=7 * DAY_MS)
E_STEPS = StepParams(threshold=28.0, min_gap_ms=DAY_MS, bucket_ms=7 * DAY_MS)
E_TIEBREAK = ["event_id"]


def _r(c: str, n: int = 6):
    return F.round(F.col(c), n).alias(c)


def round_doubles(df: DataFrame, n: int = 6) -> DataFrame:
    return df.select(*[_r(f.name, n) if f.dataType.typeName() in ("double", "float")
                       else F.col(f.name) for f in df.schema.fields])


# ---------------------------------------------------------------------------
def events_of(spark: SparkSession, sf: str) -> DataFrame:
    return T.trial_events(S.event_frames(spark, sf), E_TRIAL, key="trial_id", ts="frame_ts_ms",
                          tiebreak=E_TIEBREAK)


def q_trial_events(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(events_of(spark, sf))


def _repeated_frames(spark, sf):
    """Frames at whole six hours, so that times come several times; errors have
    no known state."""
    fr = S.event_frames(spark, sf, (F.col("event_type") != "error").alias("_ok"))
    return fr.select("trial_id", "event_id",
                     (F.col("frame_ts_ms") - F.col("frame_ts_ms") % (DAY_MS // 4)).alias("frame_ts_ms"),
                     F.when(F.col("_ok"), F.col("seated")).alias("seated"),
                     F.when(F.col("_ok"), F.col("past")).alias("past"))


def q_repeated_frame_events(spark, sf):
    """The event chain where frame times repeat and states are unknown."""
    return round_doubles(T.trial_events(_repeated_frames(spark, sf), E_TRIAL, key="trial_id",
                                        ts="frame_ts_ms", tiebreak=E_TIEBREAK))


def q_state_series(spark, sf):
    """Every trial's report series, from the same frames."""
    fr = _repeated_frames(spark, sf)
    ev = T.trial_events(fr, E_TRIAL, key="trial_id", ts="frame_ts_ms", tiebreak=E_TIEBREAK)
    return round_doubles(P.state_series(fr, ev, bucket_ms=E_TRIAL.bucket_ms, tiebreak=E_TIEBREAK))


def q_imu_series(spark, sf):
    """Every trial's IMU series: suppliers' samples, the users' times zero."""
    ev = events_of(spark, sf).withColumn("trial_id", F.col("trial_id").cast("string"))
    return round_doubles(P.imu_series(S.lineitem_imu(spark, sf), ev).select(
        "trial_id", "host_timestamp_ms", "imu_timestamp_ms", "l_linenumber", "l_partkey", "t_s",
        "accel_mag", "gyro_mag"))


def _sm(spark, sf):
    return G.smooth_flags(S.event_frames(spark, sf), ["trial_id"], "frame_ts_ms",
                          ["seated", "past"], E_TRIAL.dwell_ms, E_TRIAL.bucket_ms)


def q_smooth_state(spark, sf):
    return _sm(spark, sf).select("trial_id", "frame_ts_ms", "event_id", "s_seated", "s_past")


def q_smooth_dense(spark, sf):
    """All users' frames as one recording, smoothed over nine days: a window holds a
    third of all rows."""
    frames = S.event_frames(spark, sf).withColumn("recording", F.lit("all"))
    return G.smooth_flags(frames, ["recording"], "frame_ts_ms", ["seated", "past"], 9 * DAY_MS,
                          E_TRIAL.bucket_ms).select("frame_ts_ms", "event_id", "s_seated", "s_past")


def q_state_runs(spark, sf):
    return G.state_runs(_sm(spark, sf), ["trial_id"], "frame_ts_ms", "s_seated",
                        E_TRIAL.bucket_ms, tiebreak=E_TIEBREAK)


def q_stand_attempts(spark, sf):
    return G.transitions(_sm(spark, sf), ["trial_id"], "frame_ts_ms", "s_seated",
                         E_TRIAL.bucket_ms, tiebreak=E_TIEBREAK, out="attempts")


def _samples(spark, sf):
    return S.event_samples(spark, sf).select(
        "trial_id", F.col("host_ts_ms").alias("ts_ms"), "event_id",
        F.col("accel_mag").alias("value"))


def _peaks(spark, sf):
    return G.local_peaks(_samples(spark, sf), ["trial_id"], "ts_ms", "value", E_STEPS.threshold,
                         E_STEPS.bucket_ms, tiebreak=E_TIEBREAK)


def q_local_peaks(spark, sf):
    return _peaks(spark, sf)


def _spaced(spark, sf):
    return G.min_spacing(_peaks(spark, sf).select("trial_id", "ts_ms", "event_id"), ["trial_id"],
                         "ts_ms", E_STEPS.min_gap_ms, tiebreak=E_TIEBREAK)


def q_spaced_peaks(spark, sf):
    return _spaced(spark, sf)


def q_throttle_events(spark, sf):
    ev = _samples(spark, sf).select("trial_id", "ts_ms", "event_id")
    return G.min_spacing(ev, ["trial_id"], "ts_ms", E_STEPS.min_gap_ms, tiebreak=E_TIEBREAK)


def q_interval_cv(spark, sf):
    return round_doubles(G.interval_variation(
        _spaced(spark, sf), ["trial_id"], "ts_ms", E_STEPS.bucket_ms, tiebreak=E_TIEBREAK,
        count="n_peaks", out="interval_cv"))


# -- quality (mapping L) -----------------------------------------------------
L_KEYS = ["trial_id", "host_timestamp_ms", "imu_timestamp_ms", "l_linenumber", "l_partkey"]


def _tagged(spark, sf):
    return Q.tag_imu(S.lineitem_imu(spark, sf), tiebreak=S.LINEITEM_TIEBREAK)


def q_quality_tags(spark, sf):
    t = _tagged(spark, sf)
    return t.select(*L_KEYS, F.array_join("reasons", ",").alias("reasons"), "quality_ok")


def q_quality_clean(spark, sf):
    return round_doubles(Q.clean(_tagged(spark, sf)))


def q_reject_report(spark, sf):
    return Q.reject_report(_tagged(spark, sf))


def q_quality_counts(spark, sf):
    return Q.quality_counts(_tagged(spark, sf))


def q_dedup_flags(spark, sf):
    d = Q.duplicate_flag(S.lineitem_imu(spark, sf), ["trial_id", "host_timestamp_ms"],
                         S.LINEITEM_TIEBREAK)
    return d.select(*L_KEYS, "is_duplicate")


def _mags(spark, sf):
    li = S.lineitem_imu(spark, sf)
    return li.select(*L_KEYS, G.magnitude("accel_x_g", "accel_y_g", "accel_z_g").alias("accel_mag"),
                     G.magnitude("gyro_x_dps", "gyro_y_dps", "gyro_z_dps").alias("gyro_mag"))


def q_vector_magnitude(spark, sf):
    return round_doubles(_mags(spark, sf))


YEAR_MS = 365 * DAY_MS


def q_window_peak(spark, sf):
    """Peak gyro magnitude in the first year of each supplier's rows."""
    return round_doubles(G.peak_in_window(_mags(spark, sf), ["trial_id"], "host_timestamp_ms",
                                          "gyro_mag", float(YEAR_MS), out="peak_gyro"))


# -- pose (mapping V) --------------------------------------------------------
V_POSE = PoseParams(mark_x=0.05, mark_y=-0.03)


def _pose(spark, sf):
    return pose_features(S.embedding_landmarks(spark, sf), V_POSE)


def q_pose_angles(spark, sf):
    p = _pose(spark, sf).select("trial_id", "frame_ts_ms", "angle_left", "angle_right",
                                "knee_angle")
    return round_doubles(p, 4)


def q_pose_flags(spark, sf):
    return round_doubles(_pose(spark, sf).select("trial_id", "frame_ts_ms", "seated", "advance",
                                                 "past"), 4)


# -- fusion ------------------------------------------------------------------
def _metrics(spark, sf, events=None):
    ev = events if events is not None else events_of(spark, sf)
    imu = S.event_samples(spark, sf).select("trial_id", "host_ts_ms", "event_id", "accel_mag",
                                            "gyro_mag")
    return T.motion_metrics(imu, ev, E_STEPS, ts="host_ts_ms", tiebreak=E_TIEBREAK)


def q_motion_metrics(spark, sf):
    return round_doubles(_metrics(spark, sf))


def results_of(spark, sf):
    ev = cut(events_of(spark, sf), "events")  # for the metrics' bounds and the fused rows
    return T.fuse(ev, _metrics(spark, sf, ev)), ev


def q_trial_results(spark, sf):
    return round_doubles(results_of(spark, sf)[0])


# -- incremental keys and pending work ---------------------------------------
def _done(spark, sf):
    """Customers with a finished order stand for finished trials."""
    return (S.table(spark, sf, "orders").where("o_orderstatus = 'F'")
            .select(F.col("o_custkey").alias("trial_id")))


def q_new_trials(spark, sf):
    c = S.table(spark, sf, "customer").select(F.col("c_custkey").alias("trial_id"), "c_name")
    return R.new_keys(c, _done(spark, sf), ["trial_id"])


def q_pending_trials(spark, sf):
    cam = S.table(spark, sf, "customer").select(F.col("c_custkey").alias("trial_id"))
    imu = S.table(spark, sf, "events").select((F.col("user_id") + F.lit(1400)).alias("trial_id"))
    return R.pending({"camera": cam, "imu": imu}, _done(spark, sf), "trial_id", "camera")


def q_pending_report(spark, sf):
    """The pending report over a layer of finished trials, its order as a rank."""
    from ..plans.layers import pending_report, run_layer
    from ..session import scratch_path
    done = scratch_path(spark, "finished")
    run_layer(spark, _done(spark, sf).distinct(), lambda d: d, done, batch_id="1")
    cam = S.table(spark, sf, "customer").select(F.col("c_custkey").alias("trial_id"))
    imu = S.table(spark, sf, "events").select((F.col("user_id") + F.lit(1400)).alias("trial_id"))
    return R.global_rank(pending_report(spark, {"camera": cam, "imu": imu}, done),
                         [F.col("trial_id")], "place")


# -- strings -----------------------------------------------------------------
def q_path_metadata(spark, sf):
    pg = S.table(spark, sf, "pages").select("page_id", "url")
    u = F.col("url")
    return pg.select(
        "page_id",
        F.regexp_extract(u, r"/([a-z]+)/([0-9]+)", 1).alias("lang"),
        F.expr(r"try_cast(regexp_extract(url, '/([a-z]+)/([0-9]+)', 2) AS BIGINT)").alias("item"),
        F.expr(r"try_cast(regexp_extract(url, 'page=([0-9]+)', 1) AS INT)").alias("page"),
        F.regexp_extract(u, r"^https?://([^/?#]+)", 1).alias("host"),
        F.element_at(F.split(F.rtrim(u, F.lit("/")), "/"), -1).alias("last_part"),
        zero_pad(F.col("page_id"), 16).alias("padded_id"))


def _lines(spark, sf):
    """Raw sensor lines made of lineitem; some have a letter for a number or
    one field too many."""
    li = S.table(spark, sf, "lineitem")
    last = F.when(F.col("l_linestatus") == "O", F.col("l_returnflag")) \
            .otherwise(F.col("l_suppkey").cast("string"))
    line = F.concat(F.concat_ws(",", *[F.col(c).cast("string") for c in
                                      ("l_orderkey", "l_quantity", "l_discount", "l_tax",
                                       "l_extendedprice", "l_partkey")], last),
                    F.when(F.col("l_linenumber") == 7, F.lit(",0")).otherwise(F.lit("")))
    return li.select(line.alias("value"))


def q_parse_lines(spark, sf):
    from ..sources.files import parse_imu_lines
    return round_doubles(parse_imu_lines(_lines(spark, sf)))


# -- reports -----------------------------------------------------------------
def q_ranked_results(spark, sf):
    r = results_of(spark, sf)[0]
    return round_doubles(P.ranked_results(r).select("trial_id", "duration_s", "rank"))


def q_result_labels(spark, sf):
    return P.result_labels(results_of(spark, sf)[0])


def q_phase_marks(spark, sf):
    return round_doubles(P.phase_marks(events_of(spark, sf)).drop("t0_ms"))


def q_phase_shares(spark, sf):
    return round_doubles(P.phase_shares(events_of(spark, sf)))


def q_interpolate_marks(spark, sf):
    marks = P.phase_marks(events_of(spark, sf))
    smp = _samples(spark, sf)
    v = P.values_at_marks(smp, marks, "trial_id", "ts_ms", "value")
    return round_doubles(v.drop("at_ms"))


def q_state_fill(spark, sf):
    fr = S.event_frames(spark, sf, (F.col("event_type") == "error").alias("_err"))
    fr = fr.select("trial_id", "frame_ts_ms", "event_id",
                   F.when(~F.col("_err"), F.col("seated")).alias("seated"),
                   F.when(~F.col("_err"), F.col("past")).alias("past"))
    return G.fill_states(fr, ["trial_id"], "frame_ts_ms", ["seated", "past"], E_TRIAL.bucket_ms,
                         tiebreak=E_TIEBREAK)


SESSION_MS = 6 * 3600 * 1000


def q_session_samples(spark, sf):
    ev = S.table(spark, sf, "events").select(
        F.col("user_id").alias("trial_id"), epoch_ms("ts").alias("ms"), "event_id", "event_type")
    sessions = ev.filter(F.col("event_type") == "signup").select(
        "trial_id", F.col("event_id").alias("session_id"), F.col("ms").alias("start_ms"),
        (F.col("ms") + F.lit(SESSION_MS)).alias("end_ms"))
    samples = ev.filter(F.col("event_type") != "signup").select(
        "trial_id", F.col("event_id").alias("sample_id"), "ms")
    j = R.active_session(samples, sessions, ["trial_id"], "ms", "start_ms", "end_ms",
                         7 * DAY_MS, "session_id", tiebreak=["sample_id"])
    return j.select("trial_id", "session_id", "sample_id")


L_BUCKET = 180 * DAY_MS
#: Orders rows of one host time; equal in all of them, rows are interchangeable.
L_VALUES = ["imu_timestamp_ms", "accel_x_g", "accel_y_g", "accel_z_g", "gyro_x_dps", "gyro_y_dps",
            "gyro_z_dps"]


def q_chunk_index(spark, sf):
    li = S.lineitem_imu(spark, sf).withColumn("_one", F.lit(1).cast("long"))
    s = scan(li, ["trial_id"], "host_timestamp_ms", L_BUCKET, tiebreak=S.LINEITEM_TIEBREAK,
             cumsum=["_one"])
    return s.select(*L_KEYS, F.floor((F.col("cum__one") - 1) / F.lit(500)).cast("long")
                    .alias("chunk_no"))


HOUR_MS = 3_600_000


def q_rate_per_hour(spark, sf):
    ev = S.table(spark, sf, "events").select(F.col("user_id").alias("trial_id"),
                                             epoch_ms("ts").alias("ms"))
    r = G.window_counts(ev, ["trial_id"], "ms", HOUR_MS, 30 * DAY_MS, out="n_events")
    return r.withColumnRenamed("window_start_ms", "hour_ms")


def q_trial_counts(spark, sf):
    return R.row_counts({
        "n_frames": S.table(spark, sf, "events").select(
            F.col("user_id").cast("string").alias("trial_id")),
        "n_samples": S.table(spark, sf, "lineitem").select(
            F.col("l_suppkey").cast("string").alias("trial_id"))}, "trial_id")


# -- inference (UD-3) ---------------------------------------------------------
def q_detect_landmarks(spark, sf):
    """Frames carry their embedding as text bytes; the stub detector turns
    them into landmarks inside a mapInPandas job."""
    from ..operators.inference import detect_landmarks, stub_detector_factory
    frames = S.embedding_images(spark, sf)
    lm = detect_landmarks(frames, stub_detector_factory())
    x = lm.select("trial_id", "frame_ts_ms", F.explode("landmarks").alias("l"))
    return round_doubles(x.select("trial_id", "frame_ts_ms", F.col("l.landmark_id").alias("landmark_id"),
                                  F.col("l.x").cast("double").alias("x"),
                                  F.col("l.y").cast("double").alias("y"),
                                  F.col("l.visibility").cast("double").alias("visibility")))


def _camera_frames(spark, sf):
    """Frames as a camera gives them: some without a time or content, some torn."""
    i = F.col("vec_id")
    text = F.encode(F.concat_ws(",", F.transform("embedding", lambda x: x.cast("string"))), "UTF-8")
    return S.table(spark, sf, "embeddings").select(
        F.col("label").cast("string").alias("trial_id"),
        F.when(i % 17 != 5, i).alias("frame_ts_ms"),
        F.when(i % 13 == 2, F.encode(F.lit("torn"), "UTF-8"))
         .when(i % 19 != 7, text).alias("content"))


def _batch_stub():
    from ..operators.inference import one_by_one, stub_detector_factory
    return one_by_one(stub_detector_factory())


def q_detect_batches(spark, sf):
    """Landmarks per frame and the reason where there are none; frames go to the
    detector in batches."""
    from ..operators.inference import detect_batches
    d = detect_batches(_camera_frames(spark, sf), _batch_stub(), batch_frames=16)
    return d.select("trial_id", "frame_ts_ms", F.size("landmarks").cast("long").alias("n_landmarks"),
                    "reason")


def q_rejected_frames(spark, sf):
    """Frames left out or failed, counted by reason."""
    from ..operators.inference import detect_batches, failed_frames, rejected_frames
    fr = _camera_frames(spark, sf)
    bad = failed_frames(detect_batches(fr, _batch_stub())).drop("frame_ts_ms")
    return (bad.unionByName(rejected_frames(fr)).groupBy("trial_id", "reason")
            .agg(F.count(F.lit(1)).alias("n_frames")))


# -- streaming and layers (files derived from the tables) --------------------
def _events_csv_rows(spark, sf):
    return S.table(spark, sf, "events").select(
        epoch_ms("ts").alias("ms"), "event_id", "value",
        F.col("user_id").cast("string").alias("trial_id"))


def _export_events_csv(spark, sf):
    """Files of many trials each, the trial a column: a folder a trial would make as many
    files as there are trials."""
    from ..session import scratch_path
    path = scratch_path(spark, "events-csv")
    _events_csv_rows(spark, sf).write.option("header", True).csv(path)
    return path


EV_CSV_SCHEMA = "ms long, event_id long, value double, trial_id string"


def q_stream_ingest(spark, sf):
    from ..session import scratch_path
    from ..streaming.ingest import ingest_files
    src = _export_events_csv(spark, sf)
    out = ingest_files(spark, src, EV_CSV_SCHEMA, scratch_path(spark, "ingest-sink"),
                       scratch_path(spark, "ingest-ckpt"))
    return round_doubles(out.select("trial_id", "ms", "event_id", "value"))


def q_stream_rate(spark, sf):
    """Hourly counts per trial from a watermarked stream, append mode: only
    windows the watermark (max event time - 1 h) has passed are emitted."""
    from ..session import scratch_path
    from ..streaming.ingest import rate_per_window, run_available
    src = _export_events_csv(spark, sf)
    st = (spark.readStream.schema(EV_CSV_SCHEMA).option("header", True).csv(src)
          .withColumn("ts", F.timestamp_millis("ms")))
    agg = rate_per_window(st, "trial_id", "ts", "1 hour", "1 hour")
    sink = scratch_path(spark, "rate-sink")
    run_available(agg, sink, scratch_path(spark, "rate-ckpt"))
    r = spark.read.parquet(sink)
    return r.select("trial_id", F.unix_millis("window_start").alias("window_start_ms"), "n_rows")


def q_stream_rate_all(spark, sf):
    """The same counts with the windows that are still open."""
    from ..session import scratch_path
    from ..streaming.ingest import rate_per_window, run_updates
    src = _export_events_csv(spark, sf)
    st = (spark.readStream.schema(EV_CSV_SCHEMA).option("header", True).csv(src)
          .withColumn("ts", F.timestamp_millis("ms")))
    r = run_updates(rate_per_window(st, "trial_id", "ts", "1 hour", "1 hour"),
                    scratch_path(spark, "rate-sink"), scratch_path(spark, "rate-ckpt"),
                    ["trial_id", "window_start"])
    return r.select("trial_id", F.unix_millis("window_start").alias("window_start_ms"), "n_rows")


def _event_stream(spark, sf):
    """The events as a stream of files, their time a timestamp."""
    from ..session import scratch_path
    path = scratch_path(spark, "event-files")
    ev = S.table(spark, sf, "events").select(F.col("user_id").alias("trial_id"), "event_id",
                                             "event_type", F.col("ts").cast("timestamp").alias("ts"))
    ev.write.parquet(path)
    return spark.readStream.schema(ev.schema).parquet(path)


def q_stream_running_total(spark, sf):
    """Hourly counts per trial and the total so far, from a stream: windows that the
    watermark (last event - 1 h) has passed."""
    from ..session import scratch_path
    from ..streaming.stateful import run_stateful, running_total
    sink = scratch_path(spark, "total-sink")
    run_stateful(running_total(_event_stream(spark, sf), "trial_id", "ts", "1 hour", "1 hour"),
                 sink, scratch_path(spark, "total-ckpt"))
    return spark.read.parquet(sink)


def q_stream_sessions(spark, sf):
    """Samples with the session active then, both from streams: day buckets that the
    watermark (the lesser of the two last times - 1 h) has passed."""
    from ..session import scratch_path
    from ..streaming.stateful import live_sessions, run_stateful
    ev = _event_stream(spark, sf)
    starts = ev.where("event_type = 'signup'").select(
        "trial_id", F.col("event_id").alias("session_id"), F.col("ts").alias("start"),
        F.timestamp_millis(F.unix_millis("ts") + F.lit(SESSION_MS)).alias("end"))
    samples = ev.where("event_type <> 'signup'").select(
        "trial_id", F.col("event_id").alias("sample_id"), "ts")
    sink = scratch_path(spark, "sessions-sink")
    run_stateful(live_sessions(samples, starts, "trial_id", "ts", "sample_id", "start", "end",
                               "session_id", "1 hour", SESSION_MS, DAY_MS),
                 sink, scratch_path(spark, "sessions-ckpt"))
    return spark.read.parquet(sink)


def q_layer_silver(spark, sf):
    """Bronze -> silver run twice over IMU CSV files exported from lineitem;
    the second run finds nothing new. Returns the silver table."""
    from ..plans.layers import read_layer, run_layer
    from ..session import scratch_path
    from ..sources.files import read_imu_csv
    src = scratch_path(spark, "imu-csv")
    li = S.lineitem_imu(spark, sf)
    (li.select("host_timestamp_ms", "imu_timestamp_ms", "accel_x_g", "accel_y_g", "accel_z_g",
               "gyro_x_dps", "gyro_y_dps", "gyro_z_dps", "trial_id")
       .write.option("header", True).csv(src))
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")

    def to_silver(df):
        return Q.clean(Q.tag_imu(df, tiebreak=["imu_timestamp_ms", "_src_file", "_src_row"])) \
            .drop("_src_file", "_src_row", "batch_id")

    for run in (1, 2):
        run_layer(spark, read_imu_csv(spark, src), lambda d: d, bronze, batch_id=f"b{run}",
                  order=["host_timestamp_ms"])
        run_layer(spark, S.with_row_identity(read_layer(spark, bronze)), to_silver, silver,
                  batch_id=f"s{run}",
                  order=["host_timestamp_ms"])
    return round_doubles(read_layer(spark, silver).drop("batch_id"))


def q_layer_reuse(spark, sf):
    """One batch id for two runs: first only the customers of some nations,
    then all; nothing loaded before is lost."""
    from ..plans.layers import read_layer, run_layer
    from ..session import scratch_path
    c = S.table(spark, sf, "customer").select(F.col("c_custkey").alias("trial_id"), "c_name",
                                              "c_nationkey")
    target = scratch_path(spark, "reused")
    for rows in (c.where("c_nationkey < 10"), c):
        run_layer(spark, rows, lambda d: d, target, batch_id="same")
    return read_layer(spark, target).drop("batch_id")


def q_fusion_results(spark, sf):
    """The fusion step itself, on layers written from the events: run before
    the IMU layer exists (it must write nothing), then after."""
    from ..plans import chains
    from ..plans.layers import read_layer, run_layer
    from ..session import scratch_path
    p = chains.Paths(*[scratch_path(spark, f"fusion-{n}") for n in
                       ("imu", "cam", "b-imu", "b-cam", "s-imu", "s-cam", "g-cam", "res")])
    run_layer(spark, S.event_frames(spark, sf).drop("event_id"), lambda d: d, p.gold_camera,
              batch_id="1", order=["frame_ts_ms"])
    before = chains.fusion(spark, p, "1", E_TRIAL, E_STEPS)
    if before.status != "missing_upstream":
        raise RuntimeError(f"fusion without an IMU layer: {before.status}")
    none = F.lit(0.0)
    imu = S.event_samples(spark, sf).select(
        "trial_id", F.col("host_ts_ms").cast("double").alias("host_timestamp_ms"),
        F.col("event_id").alias("imu_timestamp_ms"),
        F.col("accel_mag").alias("accel_x_g"), none.alias("accel_y_g"), none.alias("accel_z_g"),
        F.col("gyro_mag").alias("gyro_x_dps"), none.alias("gyro_y_dps"), none.alias("gyro_z_dps"))
    run_layer(spark, imu, lambda d: d, p.silver_imu, batch_id="1", order=["host_timestamp_ms"])
    chains.fusion(spark, p, "1", E_TRIAL, E_STEPS)
    return round_doubles(read_layer(spark, p.results).drop("batch_id"))


def q_imu_chain(spark, sf):
    """The IMU chain itself over CSV files of 500 rows; returns silver."""
    from ..plans import chains
    from ..plans.layers import read_layer, write_chunked_csv
    from ..session import scratch_path
    p = chains.Paths(*[scratch_path(spark, f"chain-{n}") for n in
                       ("imu", "cam", "b-imu", "b-cam", "s-imu", "s-cam", "g-cam", "res")])
    write_chunked_csv(S.lineitem_imu(spark, sf).select(
        "trial_id", "host_timestamp_ms", "imu_timestamp_ms", "accel_x_g", "accel_y_g",
        "accel_z_g", "gyro_x_dps", "gyro_y_dps", "gyro_z_dps"), p.imu_source, bucket_ms=L_BUCKET)
    chains.imu_chain(spark, p, "1")
    return round_doubles(read_layer(spark, p.silver_imu).drop("batch_id"))


def q_chain_late_files(spark, sf):
    """The IMU chain by files, fed twice: the second files belong to trials that are
    loaded already. Returns silver."""
    from ..plans import chains
    from ..session import scratch_path
    from ..sources.files import write_trial_csv
    p = chains.Paths(*[scratch_path(spark, f"late-{n}") for n in
                       ("imu", "cam", "b-imu", "b-cam", "s-imu", "s-cam", "g-cam", "res")])
    rows = S.lineitem_imu(spark, sf)
    late = F.coalesce(F.col("l_linenumber"), F.lit(0)) > 3
    checkpoint = scratch_path(spark, "late-ckpt")
    for part in (~late, late):
        write_trial_csv(rows.where(part).select(
            "host_timestamp_ms", "imu_timestamp_ms", "accel_x_g", "accel_y_g", "accel_z_g",
            "gyro_x_dps", "gyro_y_dps", "gyro_z_dps", "trial_id"), p.imu_source)
        silver = chains.imu_file_chain(spark, p, checkpoint)
    return round_doubles(silver.drop("batch_id"))


def q_camera_chain(spark, sf):
    """The camera chain itself over frame files (one per frame, named by its
    time in a folder per trial); returns the gold flags."""
    from ..operators.inference import stub_detector_factory
    from ..plans import chains
    from ..plans.layers import read_layer
    from ..session import scratch_path
    from ..sources.files import write_frames
    p = chains.Paths(*[scratch_path(spark, f"chain-{n}") for n in
                       ("imu", "cam", "b-imu", "b-cam", "s-imu", "s-cam", "g-cam", "res")])
    write_frames(S.embedding_images(spark, sf), p.camera_source)
    chains.camera_chain(spark, p, stub_detector_factory(), "1", V_POSE)
    return read_layer(spark, p.gold_camera).drop("batch_id")


def q_sample_seconds(spark, sf):
    """Seconds of every sample since its trial's first, and those as whole
    milliseconds."""
    d = G.rebase(_samples(spark, sf).select("trial_id", "ts_ms", "event_id"), ["trial_id"],
                 "ts_ms")
    return round_doubles(d.withColumn("t_ms", seconds_to_ms("t_s")))


def q_rejected_lines(spark, sf):
    """How many raw lines the parser drops, by reason."""
    from ..sources.files import rejected_imu_lines
    return (rejected_imu_lines(_lines(spark, sf)).groupBy("reason")
            .agg(F.count(F.lit(1)).alias("n_lines")))


def q_camera_layers(spark, sf):
    """Frames (embedding text as frame bytes) -> bronze -> landmarks (silver,
    stub detector) -> per-frame flags (gold), each an incremental layer step
    run twice; returns the gold table."""
    from ..operators.inference import detect_landmarks, stub_detector_factory
    from ..plans.layers import read_layer, run_layer
    from ..session import scratch_path
    frames = S.embedding_images(spark, sf)
    bronze, silver, gold = (scratch_path(spark, n) for n in ("cam-bronze", "cam-silver", "cam-gold"))

    def to_gold(d):
        return pose_features(d.drop("batch_id"), V_POSE).select("trial_id", "frame_ts_ms",
                                                                "seated", "past")

    for run in ("1", "2"):
        run_layer(spark, frames, lambda d: d, bronze, batch_id=run, order=["frame_ts_ms"])
        run_layer(spark, read_layer(spark, bronze),
                  lambda d: detect_landmarks(d, stub_detector_factory()), silver, batch_id=run,
                  order=["frame_ts_ms"])
        run_layer(spark, read_layer(spark, silver), to_gold, gold, batch_id=run,
                  order=["frame_ts_ms"])
    return read_layer(spark, gold).drop("batch_id")


def q_source_trials(spark, sf):
    """Distinct trial ids under a source folder, from file paths only."""
    from ..session import scratch_path
    from ..sources.files import source_trial_ids, write_trial_csv
    path = scratch_path(spark, "events-csv")
    write_trial_csv(_events_csv_rows(spark, sf), path)
    return source_trial_ids(spark, path)


def _export_lines(spark, sf):
    from ..session import scratch_path
    path = scratch_path(spark, "raw-lines")
    _lines(spark, sf).write.text(path)
    return path


def q_stream_lines(spark, sf):
    """Raw sensor lines read as a stream (availableNow), parsed, bad lines
    dropped; the sink is returned."""
    from ..session import scratch_path
    from ..sources.files import read_raw_lines
    from ..streaming.ingest import run_available
    src = _export_lines(spark, sf)
    sink = scratch_path(spark, "lines-sink")
    run_available(read_raw_lines(spark, src, streaming=True), sink,
                  scratch_path(spark, "lines-ckpt"))
    return round_doubles(spark.read.parquet(sink))


def _streamed_lines(spark, sf):
    from ..session import scratch_path
    from ..streaming.ingest import ingest_lines
    return ingest_lines(spark, _export_lines(spark, sf), scratch_path(spark, "lines-good"),
                        scratch_path(spark, "lines-bad"), scratch_path(spark, "lines-ckpt"), 2)


def q_stream_parsed(spark, sf):
    """Raw lines streamed to two tables, two files a batch; the table of parsed lines."""
    return round_doubles(_streamed_lines(spark, sf)[0])


def q_stream_rejects(spark, sf):
    """The same stream's table of rejected lines, counted by reason."""
    return (_streamed_lines(spark, sf)[1].groupBy("reason")
            .agg(F.count(F.lit(1)).alias("n_lines")))


def q_chunk_files(spark, sf):
    """IMU rows written as CSV chunks of 500 rows per trial folder; returns
    the name and sums over the contents of every written file."""
    from ..plans.layers import write_chunked_csv
    from ..sources.files import read_imu_csv
    from ..session import scratch_path
    path = scratch_path(spark, "imu-chunks")
    write_chunked_csv(S.lineitem_imu(spark, sf).select(
        "trial_id", "host_timestamp_ms", "imu_timestamp_ms", "accel_x_g", "accel_y_g",
        "accel_z_g", "gyro_x_dps", "gyro_y_dps", "gyro_z_dps"), path, bucket_ms=L_BUCKET,
        tiebreak=L_VALUES)
    rows = read_imu_csv(spark, path).withColumn("file_name", F.col("_metadata.file_name"))
    return round_doubles(rows.groupBy("trial_id", "file_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("host_timestamp_ms").alias("first_ms"),
        F.max("host_timestamp_ms").alias("last_ms"), F.sum("imu_timestamp_ms").alias("sum_imu_ms"),
        F.sum("gyro_z_dps").alias("sum_gyro_z")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "trial_events": q_trial_events,
    "smooth_state": q_smooth_state,
    "smooth_dense": q_smooth_dense,
    "state_runs": q_state_runs,
    "stand_attempts": q_stand_attempts,
    "local_peaks": q_local_peaks,
    "spaced_peaks": q_spaced_peaks,
    "throttle_events": q_throttle_events,
    "interval_cv": q_interval_cv,
    "quality_tags": q_quality_tags,
    "quality_clean": q_quality_clean,
    "reject_report": q_reject_report,
    "quality_counts": q_quality_counts,
    "dedup_flags": q_dedup_flags,
    "vector_magnitude": q_vector_magnitude,
    "window_peak": q_window_peak,
    "pose_angles": q_pose_angles,
    "pose_flags": q_pose_flags,
    "motion_metrics": q_motion_metrics,
    "trial_results": q_trial_results,
    "new_trials": q_new_trials,
    "pending_trials": q_pending_trials,
    "path_metadata": q_path_metadata,
    "parse_lines": q_parse_lines,
    "ranked_results": q_ranked_results,
    "result_labels": q_result_labels,
    "phase_marks": q_phase_marks,
    "phase_shares": q_phase_shares,
    "interpolate_marks": q_interpolate_marks,
    "state_fill": q_state_fill,
    "session_samples": q_session_samples,
    "chunk_index": q_chunk_index,
    "rate_per_hour": q_rate_per_hour,
    "trial_counts": q_trial_counts,
    "detect_landmarks": q_detect_landmarks,
    "stream_ingest": q_stream_ingest,
    "stream_rate": q_stream_rate,
    "layer_silver": q_layer_silver,
    "camera_layers": q_camera_layers,
    "source_trials": q_source_trials,
    "stream_lines": q_stream_lines,
    "stream_parsed": q_stream_parsed,
    "stream_rejects": q_stream_rejects,
    "chunk_files": q_chunk_files,
    "stream_rate_all": q_stream_rate_all,
    "layer_reuse": q_layer_reuse,
    "fusion_results": q_fusion_results,
    "imu_chain": q_imu_chain,
    "camera_chain": q_camera_chain,
    "sample_seconds": q_sample_seconds,
    "rejected_lines": q_rejected_lines,
    "repeated_frame_events": q_repeated_frame_events,
    "state_series": q_state_series,
    "imu_series": q_imu_series,
    "pending_report": q_pending_report,
    "chain_late_files": q_chain_late_files,
    "detect_batches": q_detect_batches,
    "rejected_frames": q_rejected_frames,
    "stream_running_total": q_stream_running_total,
    "stream_sessions": q_stream_sessions,
}
