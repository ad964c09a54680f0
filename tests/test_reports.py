"""FIXTURES B6: ranking, phase marks and shares, fill, interpolation."""

import pytest

from stridelake.operators.signals import fill_states, interpolate_at
from stridelake.plans import reports as P

RES = "trial_id string, finished boolean, frail boolean, attempts int, duration_s double, " \
      "stand_up_s double, to_mark_s double, turn_back_s double, back_to_chair_s double, " \
      "t0_ms long"


@pytest.fixture(scope="module")
def results(spark):
    rows = [("complete", True, True, 1, 13.0, 2.0, 3.0, 3.0, 5.0, 0),
            ("no_return", False, None, 1, None, 2.0, None, None, None, 0),
            ("under12", True, False, 1, 11.8, 2.0, 3.0, 3.0, 3.8, 0)]
    return spark.createDataFrame(rows, RES)


def test_ranking(results):
    got = [r.trial_id for r in P.ranked_results(results).orderBy("rank").collect()]
    assert got == ["complete", "under12", "no_return"]


def test_marks_and_shares(results):
    m = {}
    for r in P.phase_marks(results).collect():
        m.setdefault(r.trial_id, []).append((r.phase_no, r.t_mark_s))
    assert sorted(m["complete"]) == [(1, 2.0), (2, 5.0), (3, 8.0), (4, 13.0)]
    assert m["no_return"] == [(1, 2.0)]
    sh = {r.phase_no: r.share for r in P.phase_shares(results).collect()
          if r.trial_id == "complete"}
    assert sh == pytest.approx({1: 2 / 13, 2: 3 / 13, 3: 3 / 13, 4: 5 / 13})


def test_labels(results):
    lab = {r.trial_id: r for r in P.result_labels(results).collect()}
    assert lab["complete"].label == "complete — 13.0s ⚠"
    assert lab["no_return"].label == "no_retur — unfinished"
    assert (lab["no_return"].duration_txt, lab["no_return"].frail_txt) == ("—", "—")
    assert lab["under12"].frail_txt == "no"


def test_fill(spark):
    vals = [None, True, None, False, None]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(vals)],
                               "trial_id string, t long, s boolean")
    got = [r.s for r in fill_states(df, ["trial_id"], "t", ["s"], 2).orderBy("t").collect()]
    assert got == [True, True, True, False, False]


def test_interpolation(spark):
    smp = spark.createDataFrame([("a", 0, 0.0), ("a", 1000, 10.0)], "k string, t long, v double")
    marks = spark.createDataFrame([("a", 250.0), ("a", -1000.0), ("a", 5000.0), ("a", 1000.0)],
                                  "k string, at double")
    got = {r.at: r.value_at for r in interpolate_at(smp, marks, ["k"], "t", "v", "at").collect()}
    assert got == {250.0: 2.5, -1000.0: 0.0, 5000.0: 10.0, 1000.0: 10.0}


def test_series_for_one_trial(spark):
    gold = spark.createDataFrame(
        [("a", 1000, None, None), ("a", 1200, True, False), ("a", 1400, None, True),
         ("b", 1000, False, False)],
        "trial_id string, frame_ts_ms long, seated boolean, past boolean")
    ev = spark.createDataFrame([("a", 1200), ("b", 1000)], "trial_id string, t0_ms long")
    rows = P.state_series(gold, ev, "a").collect()
    assert [(r.seated, r.past, r.t_s) for r in rows] == \
        [(True, False, -0.2), (True, False, 0.0), (True, True, 0.2)]
    imu = spark.createDataFrame([("a", 1300.0, 0.0, 0.6, 0.8, 3.0, 4.0, 0.0)],
                                "trial_id string, host_timestamp_ms double, accel_x_g double, "
                                "accel_y_g double, accel_z_g double, gyro_x_dps double, "
                                "gyro_y_dps double, gyro_z_dps double")
    r = P.imu_series(imu, ev, "a").first()
    assert (r.t_s, r.accel_mag, r.gyro_mag) == (pytest.approx(0.1), pytest.approx(1.0), 5.0)
