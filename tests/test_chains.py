"""End to end: IMU CSV + frame files -> bronze -> silver -> gold -> results
(FIXTURES B3 'complete' trial, B4 step times), re-run writes nothing."""

import os
from dataclasses import replace

import pytest

from stridelake.operators.inference import stub_detector_factory
from stridelake.plans.chains import Paths, camera_chain, fusion, imu_chain
from stridelake.plans.layers import read_layer, run_layer, write_chunked_csv
from stridelake.session import scratch_path

T0 = 1_700_000_000_000
SIT = [.4, .5, .09, .4, .5, .09, .5, .5, .09, .5, .5, .09, .5, .6, .09, .5, .6, .09]
STAND = [.5, .4, .09, .5, .4, .09, .5, .5, .09, .5, .5, .09, .5, .6, .09, .5, .6, .09]
STAND_PAST = [.9, .5, .09, .9, .5, .09, .9, .6, .09, .9, .6, .09, .9, .7, .09, .9, .7, .09]


@pytest.fixture(scope="module")
def paths(spark):
    p = Paths(*[scratch_path(spark, n) for n in
                ["imu", "cam", "b_imu", "b_cam", "s_imu", "s_cam", "g_cam", "res"]])
    for k in range(71):
        geo = SIT if (k < 10 or k >= 65) else (STAND_PAST if 25 <= k < 40 else STAND)
        ms = T0 + 200 * k
        d = os.path.join(p.camera_source, "trial_id=complete")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"frame_{ms:016d}.jpg"), "w") as f:
            f.write(",".join(str(v) for v in geo))
    peaks = {2500, 2700, 3000, 3600, 4000}
    rows = [("complete", float(T0 + t), t, 1.5 if t in peaks else 1.0, 0.0, 0.0,
             100.0 if t < 2000 else 5.0, 0.0, 0.0) for t in range(0, 14000, 10)]
    df = spark.createDataFrame(rows, "trial_id string, host_timestamp_ms double, "
                               "imu_timestamp_ms long, accel_x_g double, accel_y_g double, "
                               "accel_z_g double, gyro_x_dps double, gyro_y_dps double, "
                               "gyro_z_dps double")
    write_chunked_csv(df, p.imu_source, bucket_ms=3000)
    return p


def test_chunked_source_files(paths):
    d = os.path.join(paths.imu_source, "trial_id=complete")
    files = [f for f in os.listdir(d) if f.endswith(".csv")]
    assert len(files) == 3  # 1400 rows in chunks of 500


def test_fusion_waits_for_both_layers(spark, paths):
    camera_only = replace(paths, silver_imu=scratch_path(spark, "none"),
                          gold_camera=scratch_path(spark, "some-cam"),
                          results=scratch_path(spark, "none-res"))
    frames = spark.createDataFrame([("a", 1, True, False)],
                                   "trial_id string, frame_ts_ms long, seated boolean, past boolean")
    run_layer(spark, frames, lambda d: d, camera_only.gold_camera)
    assert fusion(spark, camera_only).status == "missing_upstream"
    assert read_layer(spark, camera_only.results) is None


def test_chains_end_to_end(spark, paths):
    imu = imu_chain(spark, paths, "1")
    assert [r.status for r in imu] == ["written", "written"]
    assert imu[1].metrics == {"rows": 1400, "rejected": 0}
    st = camera_chain(spark, paths, stub_detector_factory(), "1")
    assert [r.status for r in st] == ["written"] * 3
    assert fusion(spark, paths, "1").status == "written"
    r = read_layer(spark, paths.results).first()
    assert (r.finished, r.frail, r.attempts) == (True, True, 1)
    assert (r.duration_s, r.stand_up_s, r.to_mark_s, r.turn_back_s, r.back_to_chair_s) == \
        pytest.approx((13.0, 2.0, 3.0, 3.0, 5.0))
    assert r.n_steps == 4 and r.step_cv == pytest.approx(0.16329931618554516)
    assert r.peak_standing_dps == pytest.approx(100.0)
    # second run: nothing new anywhere
    assert [x.status for x in imu_chain(spark, paths, "2")] == ["nothing_new"] * 2
    assert [x.status for x in camera_chain(spark, paths, stub_detector_factory(), "2")] == \
        ["nothing_new"] * 3
    assert fusion(spark, paths, "2").status == "nothing_new"
    assert read_layer(spark, paths.results).count() == 1
