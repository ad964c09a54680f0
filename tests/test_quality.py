"""FIXTURES B1: quality rules and duplicate ranking."""

import math

from stridelake.operators import quality as Q

NAN = math.nan
# (row, host_ms, imu_ms, accel_x, gyro_z, expected tags)
B1 = [
    ("r1", 1000.0, 10, 0.0, 0.0, []),
    ("r2", 1000.0, 11, 0.0, 0.0, ["duplicate_timestamp"]),
    ("r3", 1010.0, 20, None, 0.0, ["null_value"]),
    ("r4", 1020.0, 30, 8.0, 0.0, []),
    ("r5", 1030.0, 40, 8.0001, 0.0, ["accel_out_of_range"]),
    ("r6", 1040.0, 50, 0.0, -2000.5, ["gyro_out_of_range"]),
    ("r7", 1050.0, 60, 9.0, 0.0, ["accel_out_of_range"]),
    ("r8", 1050.0, 61, 0.0, 0.0, ["duplicate_timestamp"]),
    ("r9", 1060.0, 70, NAN, 0.0, ["accel_out_of_range"]),
    ("r10", 1070.0, 80, None, 3000.0, ["null_value", "gyro_out_of_range"]),
    ("r11", None, 90, 0.0, 0.0, []),
    ("r12", None, 91, 0.0, 0.0, ["duplicate_timestamp"]),
    ("r13", 1080.0, None, 0.0, 0.0, []),
    ("r14", 1080.0, 100, 0.0, 0.0, ["duplicate_timestamp"]),
]
SCHEMA = ("row string, trial_id string, host_timestamp_ms double, imu_timestamp_ms long, "
          "accel_x_g double, accel_y_g double, accel_z_g double, gyro_x_dps double, "
          "gyro_y_dps double, gyro_z_dps double")


def _df(spark):
    rows = [(r, "t", h, i, ax, 0.0, 0.0, 0.0, 0.0, gz) for r, h, i, ax, gz, _ in B1]
    return spark.createDataFrame(rows, SCHEMA)


def test_tags_in_rule_order(spark):
    got = {r.row: list(r.reasons) for r in Q.tag_imu(_df(spark), tiebreak=["row"]).collect()}
    assert got == {r: tags for r, _, _, _, _, tags in B1}


def test_clean_keeps_expected_rows(spark):
    kept = sorted(r.row for r in Q.clean(Q.tag_imu(_df(spark), tiebreak=["row"])).collect())
    assert kept == ["r1", "r11", "r13", "r4"]


def test_reject_report_and_counts(spark):
    t = Q.tag_imu(_df(spark), tiebreak=["row"])
    rep = {r.reason: r.n_rows for r in Q.reject_report(t).collect()}
    assert rep == {"duplicate_timestamp": 4, "null_value": 2, "accel_out_of_range": 3,
                   "gyro_out_of_range": 2}
    c = Q.quality_counts(t).first()
    assert (c.n_rows, c.n_rejected, c.n_kept) == (14, 10, 4)


def test_duplicate_of_identical_rows_uses_row_identity(spark):
    rows = [("a", 1.0, 5), ("a", 1.0, 5), ("a", 1.0, 5)]
    df = spark.createDataFrame(rows, "trial_id string, h double, i long")
    from pyspark.sql import functions as F
    df = df.withColumn("rid", F.monotonically_increasing_id())
    d = Q.duplicate_flag(df, ["trial_id", "h"], ["i", "rid"])
    assert sorted(r.is_duplicate for r in d.collect()) == [False, True, True]


def test_valid_first_dedup_keeps_a_valid_twin(spark):
    kept = sorted(r.row for r in Q.clean(Q.tag_imu(_df(spark), tiebreak=["row"],
                                                  dedup="valid_first")).collect())
    # r8 (valid) now wins over r7 (accel out of range) at host time 1050
    assert kept == ["r1", "r11", "r13", "r4", "r8"]


def test_only_groups_of_several_rows_are_written(spark, monkeypatch):
    """A row alone in its group costs no row of the written table; results stay."""
    written = []

    def cut(df, name):
        written.append(df.count())
        return df
    monkeypatch.setattr(Q, "cut", cut)
    rows = [("a", float(i), i) for i in range(50)] + [("b", None, 1), ("b", None, 2), (None, 3.0, 2),
                                                      (None, 3.0, 1), (None, None, 9)]
    df = spark.createDataFrame(rows, "trial_id string, h double, i long")
    d = Q.duplicate_flag(df, ["trial_id", "h"], ["i"]).collect()
    assert len(d) == len(rows) and written == [2]
    assert not any(r.is_duplicate is None for r in d)
    assert sorted((str(r.trial_id), str(r.h), r.i) for r in d if r.is_duplicate) == [
        ("None", "3.0", 2), ("b", "None", 2)]
