"""FIXTURES B2: knee angle, seated, foot advance, past-the-mark."""

import pytest

from stridelake.operators.inference import LANDMARK
from stridelake.operators.pose import pose_features

STAND = [(.5, .4), (.5, .5), (.5, .6)]
SIT = [(.4, .5), (.5, .5), (.5, .6)]
PAST = [(.9, .5), (.9, .6), (.9, .7)]
DEGEN = [(.5, .4), (.5, .5), (.5, .5)]


def side(points, ids, vis=(0.9, 0.9, 0.9)):
    return [(i, x, y, 0.0, v, 1.0) for i, (x, y), v in zip(ids, points, vis)]


def frame(left, right, lvis=(0.9, 0.9, 0.9), rvis=(0.9, 0.9, 0.9)):
    return side(left, (23, 25, 27), lvis) + side(right, (24, 26, 28), rvis)


CASES = {
    # name: (landmarks, angle, seated, advance, past)
    "stand": (frame(STAND, STAND), 180.0, False, -0.0345, False),
    "sit": (frame(SIT, SIT), 90.0, True, -0.0345, False),
    "empty": ([], None, None, None, None),
    "leftvis": (frame(SIT, STAND, lvis=(0.5, 0.9, 0.9)), 180.0, False, -0.0345, False),
    "degenerate": (frame(DEGEN, DEGEN), 0.0, True, 0.1755, True),
    "past": (frame(PAST, STAND), 180.0, False, 0.1555, True),
    "mean135": (frame(SIT, STAND), 135.0, False, -0.0345, False),
    "hiphidden": (frame(STAND, STAND, (0.1, 0.9, 0.9), (0.1, 0.9, 0.9)), None, None, -0.0345,
                  False),
}


@pytest.fixture(scope="module")
def feats(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("trial_id", T.StringType()),
                           T.StructField("frame_ts_ms", T.LongType()),
                           T.StructField("landmarks", T.ArrayType(LANDMARK))])
    rows = [(name, i, lm) for i, (name, (lm, *_)) in enumerate(CASES.items())]
    df = spark.createDataFrame(rows, schema)
    return {r.trial_id: r for r in pose_features(df).collect()}


@pytest.mark.parametrize("name", list(CASES))
def test_pose_case(feats, name):
    _, angle, seated, advance, past = CASES[name]
    r = feats[name]
    if angle is None:
        assert r.knee_angle is None
    else:
        assert r.knee_angle == pytest.approx(angle, abs=0.05)
    assert r.seated is seated
    if advance is None:
        assert r.advance is None
    else:
        assert r.advance == pytest.approx(advance, abs=1e-4)
    assert r.past is past
