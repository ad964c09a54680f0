"""Declarative quality rules: tag every failing rule per row, then keep the
clean rows (FLT-1, FLT-5, WN-1, AG-2).

Duplicate detection is "row_number over (trial, host clock) ordered by the
device clock > 1". It is computed as a per-group minimum (partial aggregate,
so a group holding a third of all rows is combined map-side), written, and
joined back on the group key (both sides then have a shuffle of their own, and
AQE's skew join splits a hot key), instead of a window that would sort the
whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import (ACCEL_OUT_OF_RANGE, DUPLICATE_TIMESTAMP, GYRO_OUT_OF_RANGE, NULL_VALUE,
                      QualityParams)
from ..session import cut


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column  # true when the row breaks the rule; null counts as pass


def any_of(preds: Sequence[Column]) -> Column:
    out = F.lit(False)
    for p in preds:
        out = out | p
    return out


def imu_rules(p: QualityParams = QualityParams()) -> list[Rule]:
    """Null value, accel beyond range, gyro beyond range (strict limits; NaN
    compares greater than any number in Spark, so NaN is out of range)."""
    value_cols = list(p.accel_cols) + list(p.gyro_cols) + list(p.extra_null_cols)
    return [
        Rule(NULL_VALUE, any_of([F.col(c).isNull() for c in value_cols])),
        Rule(ACCEL_OUT_OF_RANGE, any_of([F.abs(F.col(c)) > F.lit(p.accel_range)
                                         for c in p.accel_cols])),
        Rule(GYRO_OUT_OF_RANGE, any_of([F.abs(F.col(c)) > F.lit(p.gyro_range)
                                        for c in p.gyro_cols])),
    ]


def _null_safe_key(df: DataFrame, c: str) -> list[Column]:
    """(is null, value or a filler) as two plain columns: grouping and an
    ordinary equi-join on them treat null as one value."""
    t = df.schema[c].dataType.typeName()
    if t == "string":
        fill = F.lit("")
    elif t in ("integer", "long", "short", "byte", "double", "float", "decimal", "boolean"):
        fill = F.lit(0).cast(df.schema[c].dataType)
    else:
        return [F.col(c).isNull().alias(f"_gn_{c}"),
                F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_gv_{c}")]
    return [F.col(c).isNull().alias(f"_gn_{c}"), F.coalesce(F.col(c), fill).alias(f"_gv_{c}")]


def duplicate_flag(df: DataFrame, group: Sequence[str], order: Sequence[str],
                   out: str = "is_duplicate") -> DataFrame:
    """``row_number() over (partition by group order by order) > 1``.

    ``order`` must make rows of a group distinct (add every remaining column
    as a tie-break). Nulls sort first, null group keys form one group.
    """
    group = list(group)
    kcols = [x for g in group for x in (f"_gn_{g}", f"_gv_{g}")]
    d = df.select("*", *[k for g in group for k in _null_safe_key(df, g)])
    okey = F.struct(*[F.col(c) for c in order])
    # written, so that AQE can split the join where a group is hot; a row alone in its
    # group needs no partner
    first = cut(d.groupBy(*kcols).agg(F.min(okey).alias("_first"), F.count(F.lit(1)).alias("_n"))
                .where("_n > 1").drop("_n"), "first-rows")
    j = d.join(first, kcols, "left")
    return j.withColumn(out, F.col("_first").isNotNull() & ~okey.eqNullSafe(F.col("_first"))) \
            .drop("_first", *kcols)


def tag_rules(df: DataFrame, rules: Sequence[Rule], duplicate_col: str | None = None,
              reasons: str = "reasons", ok: str = "quality_ok") -> DataFrame:
    """Array of failing rule names (rule order), and ``quality_ok``."""
    items = [F.when(r.fails, F.lit(r.name)) for r in rules]
    if duplicate_col:
        items.append(F.when(F.col(duplicate_col), F.lit(DUPLICATE_TIMESTAMP)))
    d = df.withColumn(reasons, F.array_compact(F.array(*items)))
    return d.withColumn(ok, F.size(reasons) == 0)


def tag_imu(df: DataFrame, p: QualityParams = QualityParams(), key: str = "trial_id",
            host_ts: str = "host_timestamp_ms", device_ts: str = "imu_timestamp_ms",
            tiebreak: Sequence[str] = (), dedup: str = "all_rows") -> DataFrame:
    """The silver IMU rule set: nulls, ranges, duplicate host timestamps.

    ``dedup="all_rows"`` (reference behaviour, D5) ranks duplicates over all
    rows, failing ones included, so a valid row can lose to an invalid one
    and both go. ``dedup="valid_first"`` ranks rows passing the other rules
    first, so one valid row of each group survives when there is one.
    """
    rules = imu_rules(p)
    order = [device_ts] + [c for c in tiebreak if c != device_ts]
    d = df
    if dedup == "valid_first":
        d = d.withColumn("_fails", F.coalesce(any_of([r.fails for r in rules]), F.lit(False)))
        order = ["_fails"] + order
    elif dedup != "all_rows":
        raise ValueError(f"unknown dedup mode {dedup!r}")
    d = duplicate_flag(d, [key, host_ts], order, out="_dup")
    return tag_rules(d, rules, duplicate_col="_dup").drop("_dup", "_fails")


def clean(tagged: DataFrame, reasons: str = "reasons", ok: str = "quality_ok") -> DataFrame:
    return tagged.filter(F.col(ok)).drop(reasons, ok)


def reject_report(tagged: DataFrame, reasons: str = "reasons") -> DataFrame:
    """Rows per failing rule (a row failing two rules counts for both)."""
    return (tagged.select(F.explode(reasons).alias("reason"))
                  .groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))


def quality_counts(tagged: DataFrame, ok: str = "quality_ok") -> DataFrame:
    """Total, rejected and kept rows in one pass."""
    return tagged.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.count_if(~F.col(ok)).alias("n_rejected"),
                      F.count_if(F.col(ok)).alias("n_kept"))
