"""Per-frame pose features from a landmark array (PRJ-3 .. PRJ-8).

Each landmark is looked up once as a point: a struct of its place in double
precision, null unless it is trusted (visibility strictly above the minimum).
Features of untrusted points are then null by themselves.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import PoseParams


def landmark(arr: str | Column, landmark_id: int) -> Column:
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.try_element_at(F.filter(a, lambda l: l["landmark_id"] == F.lit(landmark_id)),
                            F.lit(1))


def trusted_point(mark: Column, visibility_min: float) -> Column:
    """struct(x, y) of a landmark, null if it is not visible enough."""
    return F.when(mark["visibility"].cast("double") > F.lit(visibility_min),
                  F.struct(mark["x"].cast("double").alias("x"),
                           mark["y"].cast("double").alias("y")))


def joint_angle(at: Column, one: Column, other: Column, degenerate: str) -> Column:
    """Degrees between the limbs from ``at`` to two other points, as the
    angle of (dot product, cross product); null if a point is null. A limb
    without length has both products zero and so an angle of 0, or null with
    ``degenerate="null"``."""
    limbs = [[p[c] - at[c] for c in ("x", "y")] for p in (one, other)]
    (ax, ay), (bx, by) = limbs
    angle = F.degrees(F.atan2(F.abs(ax * by - ay * bx), ax * bx + ay * by))
    if degenerate == "null":
        short = reduce(lambda x, y: x | y, ((x == 0) & (y == 0) for x, y in limbs))
        angle = F.when(~short, angle)
    return angle


def mean_known(*cols: Column) -> Column:
    """Mean of the non-null values, null when none is known (PRJ-5)."""
    return F.try_divide(reduce(add, (F.coalesce(c, F.lit(0.0)) for c in cols)),
                        reduce(add, (c.isNotNull().cast("int") for c in cols)))


def pose_features(df: DataFrame, p: PoseParams = PoseParams(), landmarks: str = "landmarks",
                  keep: tuple[str, ...] = ("trial_id", "frame_ts_ms")) -> DataFrame:
    """Angles, seated flag, foot advance and past-the-mark flag per frame.

    The foot that counts is the one further ahead among the trusted ankles; of
    two level ones the left.
    """
    sides = ("left", "right")
    ids = {f"_{part}_{side}": i for part, pair in
           (("hip", p.hips), ("knee", p.knees), ("ankle", p.ankles)) for side, i in zip(sides, pair)}
    d = df.select(*keep, *(trusted_point(landmark(landmarks, i), p.visibility_min).alias(n)
                           for n, i in ids.items()))
    feet = [F.col(f"_ankle_{s}") for s in sides]
    d = d.select(
        *keep,
        *(joint_angle(F.col(f"_knee_{s}"), F.col(f"_hip_{s}"), F.col(f"_ankle_{s}"), p.degenerate)
          .alias(f"angle_{s}") for s in sides),
        F.when(feet[1].isNull() | (feet[0]["x"] >= feet[1]["x"]), feet[0]).otherwise(feet[1])
        .alias("_foot"))
    ahead = ((F.col("_foot.x") - F.lit(p.mark_x)) * F.lit(p.dir_x)
             + (F.col("_foot.y") - F.lit(p.mark_y)) * F.lit(p.dir_y))
    d = d.select(*keep, "angle_left", "angle_right",
                 mean_known(F.col("angle_left"), F.col("angle_right")).alias("knee_angle"),
                 ahead.alias("advance"))
    return d.select("*", (F.col("knee_angle") < F.lit(p.seated_angle_max)).alias("seated"),
                    (F.col("advance") > 0).alias("past"))
