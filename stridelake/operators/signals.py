"""Signal operators on per-trial time series, all skew-safe (see sequence.py).

smooth_flags    centred time-range majority vote on boolean states (WN-2)
state_runs      maximal runs of equal value -> (value, start, end) (WN-3)
transitions     true -> false transition count (AG-4)
local_peaks     strict local maxima above a threshold (WN-4a)
min_spacing     greedy "at least gap after the last accepted" filter (WN-4b,
                WN-7); exact, distributed
fill_states     forward then backward fill (WN-5)
peak_in_window  largest value in a window from the key's first row (AG-8)
interval_variation  count and variation of the intervals between rows (AG-10)
rebase          time since the first sample of the key (PRJ-10, WN-6)
interpolate_at  value of a signal at given instants, np.interp style (JN-6)
window_counts   rows per key and fixed time window, with a running total (AG-14)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, per_key
from . import greedy
from .sequence import BKT, bucket_of, frame_sums, scan, wide_frame_sums


def magnitude(*cols: str | Column) -> Column:
    """Euclidean norm of 3-axis (or any) components (PRJ-9)."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    total = cs[0] * cs[0]
    for c in cs[1:]:
        total = total + c * c
    return F.sqrt(total)


def smooth_flags(df: DataFrame, keys: Sequence[str], ts: str, flags: Sequence[str],
                 dwell_ms: int, bucket_ms: int, keep_bucket: bool = False,
                 prefix: str = "s_") -> DataFrame:
    """Majority of each boolean over the window (t - w/2, t + w/2].

    The reference rolls a centred time window whose left edge is open; on
    integer milliseconds that is ``RANGE BETWEEN w/2 - 1 PRECEDING AND w/2
    FOLLOWING``. The mean must be strictly above 0.5; it is null where no state in
    the window is known. Linear in the rows, whatever a window holds.
    """
    half = dwell_ms // 2
    lower, upper = -(half - 1), half
    width = max(bucket_ms, upper - lower)
    sums = {}
    for f in flags:
        sums[f"_true_{f}"] = F.col(f).cast("long")
        sums[f"_known_{f}"] = F.col(f).isNotNull().cast("long")
    if upper - lower > bucket_ms:  # a bucket of such a width may hold most of the rows
        out = wide_frame_sums(df, keys, ts, lower, upper, bucket_ms, sums)
        out = out.withColumn(BKT, bucket_of(ts, width)) if keep_bucket else out
    else:
        out = frame_sums(df, keys, ts, lower, upper, width, sums, keep_bucket=keep_bucket)
    return out.withColumns({
        f"{prefix}{f}": F.when(F.col(f"_known_{f}") > 0, 2 * F.col(f"_true_{f}") > F.col(f"_known_{f}"))
        for f in flags}).drop(*sums)


def state_runs(df: DataFrame, keys: Sequence[str], ts: str, value: str, bucket_ms: int,
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """Gaps and islands: one row per run ``(keys, run_no, value, t_start,
    t_end, n_rows)``. Run numbers restart at 1 for every key."""
    keys = list(keys)
    s = scan(df.select(*keys, ts, *tiebreak, value), keys, ts, bucket_ms,
             tiebreak=tiebreak, runs=[value])
    return (s.groupBy(*keys, F.col(f"run_{value}").alias("run_no"))
             .agg(F.max(value).alias("value"), F.min(ts).alias("t_start"),
                  F.max(ts).alias("t_end"), F.count(F.lit(1)).alias("n_rows")))


def transitions(df: DataFrame, keys: Sequence[str], ts: str, value: str, bucket_ms: int,
                tiebreak: Sequence[str] = (), out: str = "transitions") -> DataFrame:
    """Number of adjacent (true, false) pairs per key."""
    keys = list(keys)
    s = scan(df.select(*keys, ts, *tiebreak, value), keys, ts, bucket_ms,
             tiebreak=tiebreak, lag=[value])
    return s.groupBy(*keys).agg(
        F.count_if(F.col(f"prev_{value}") & ~F.col(value)).cast("long").alias(out))


def local_peaks(df: DataFrame, keys: Sequence[str], ts: str, value: str, threshold: float,
                bucket_ms: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Rows strictly above both neighbours and above ``threshold``. The first
    and last row of a key never qualify; a plateau is no peak."""
    s = scan(df, list(keys), ts, bucket_ms, tiebreak=tiebreak, lag=[value], lead=[value])
    v = F.col(value)
    cond = (F.col("has_prev") & F.col("has_next")
            & (v > F.col(f"prev_{value}")) & (v > F.col(f"next_{value}"))
            & (v > F.lit(threshold)))
    return s.filter(cond).drop(f"prev_{value}", f"next_{value}", "has_prev", "has_next")


#: Buckets (or runs of buckets) of one key that a task follows at most.
WALK_RUN = 512


def _most_rows(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the key that has most."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def min_spacing(df: DataFrame, keys: Sequence[str], ts: str, gap, *,
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """Greedy spacing: walk rows in time order, keep a row when it is at
    least ``gap`` (> 0) after the last kept one (``t >= last + gap``). Rows
    without a time are dropped.

    Exact and distributed, with one method for every density. Rows go to
    buckets of four gaps, so a key of any length is spread over many tasks.

    1. In each bucket, where the walk leaves it (its last kept row) is worked
       out for every place where it may enter. Walks merge fast, so a bucket
       gives few (last entry, exit) pairs.
    2. Runs of ``WALK_RUN`` neighbouring buckets compose their ways into one, runs
       of runs again, until a key has few. The walk is followed over these, then,
       knowing the last row before each run, over the buckets of every run, so
       that no task follows all buckets of a key.
    3. Each bucket, now knowing the last row kept before it, marks its rows.
    """
    keys = list(keys)
    kind = df.schema[ts].dataType.simpleString()
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    rows = df.where(F.col(ts).isNotNull()).withColumn(
        "_b", F.floor(F.col(ts) / F.lit(4 * gap)).cast("long"))
    part = [*keys, "_b"]

    def in_groups(d: DataFrame, of: Sequence[str], order: Sequence[str]) -> DataFrame:
        return (d.withColumn("_g", F.xxhash64(*of)).repartition(*of)
                .sortWithinPartitions(*of, *order))

    times = in_groups(rows.select(*part, ts), part, [ts])
    ways = times.mapInArrow(
        lambda batches: greedy.bucket_ways(batches, keys, ts, gap),
        f"{kinds}, _b bigint, entry array<{kind}>, exit array<{kind}>")
    run_of = F.expr(f"(_b - pmod(_b, {WALK_RUN})) div {WALK_RUN}")
    levels = [cut(ways, "ways")]
    while _most_rows(levels[-1], keys) > WALK_RUN:
        runs = levels[-1].withColumn("_p", run_of)
        levels.append(cut(in_groups(runs, [*keys, "_p"], ["_b"]).mapInArrow(
            lambda batches: greedy.compose(batches, keys, gap), ways.schema), "composed-ways"))
    top = levels.pop()
    entered = in_groups(top.withColumn("_in", F.lit(None).cast(kind)), keys, ["_b"]).mapInArrow(
        lambda batches: greedy.follow(batches, keys, gap), f"{kinds}, _b bigint, _last {kind}")
    for level in reversed(levels):
        before = per_key(entered.withColumnsRenamed({"_b": "_p", "_last": "_in"}), "run-entries")
        runs = level.withColumn("_p", run_of).join(before, [*keys, "_p"])
        entered = in_groups(runs, [*keys, "_p"], ["_b"]).mapInArrow(
            lambda batches: greedy.follow(batches, keys, gap), f"{kinds}, _b bigint, _last {kind}")
    known = rows.join(per_key(entered, "spacing"), part)
    out = in_groups(known, part, [ts, *tiebreak])
    columns = df.columns
    return out.mapInArrow(lambda batches: greedy.kept_rows(batches, columns, ts, gap), df.schema)


def peak_in_window(df: DataFrame, keys: Sequence[str], ts: str, value: str, length,
                   out: str = "peak") -> DataFrame:
    """Largest ``value`` of each key within ``length`` of its first row."""
    keys = list(keys)
    t0 = per_key(df.groupBy(*keys).agg(F.min(ts).alias("_t0")), "first-times")
    inside = F.col(ts) <= F.col("_t0") + F.lit(length)
    return df.join(t0, keys).groupBy(*keys).agg(F.max(F.when(inside, F.col(value))).alias(out))


def interval_variation(df: DataFrame, keys: Sequence[str], ts: str, bucket_ms: int, *,
                       tiebreak: Sequence[str] = (), count: str = "n",
                       out: str = "cv") -> DataFrame:
    """Rows of each key, and the variation (population deviation / mean) of
    the seconds between them, null below two intervals (AG-10)."""
    s = scan(df, list(keys), ts, bucket_ms, tiebreak=tiebreak, lag=[ts])
    s = s.withColumn("_iv", (F.col(ts) - F.col(f"prev_{ts}")) / F.lit(1000.0))
    return s.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count),
        F.when(F.count("_iv") >= 2,
               F.try_divide(F.stddev_pop("_iv"), F.avg("_iv"))).alias(out))


def fill_states(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str],
                bucket_ms: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Forward fill, then backward fill the leading gap (pandas ffill().bfill())."""
    s = scan(df, list(keys), ts, bucket_ms, tiebreak=tiebreak, ffill=cols, bfill=cols)
    for c in cols:
        s = s.withColumn(c, F.coalesce(F.col(f"ffill_{c}"), F.col(f"bfill_{c}"))) \
             .drop(f"ffill_{c}", f"bfill_{c}")
    return s


def rebase(df: DataFrame, keys: Sequence[str], ts: str, out: str = "t_s",
           origin: DataFrame | None = None, origin_col: str = "t0") -> DataFrame:
    """Seconds since the key's origin (default: its first sample).

    The origin is a per-key aggregate, written and joined back, not a window
    over the key.
    """
    keys = list(keys)
    if origin is None:
        origin = df.groupBy(*keys).agg(F.min(ts).alias(origin_col))
    d = df.join(per_key(origin.select(*keys, origin_col), "origin"), keys, "left")
    return d.withColumn(out, (F.col(ts) - F.col(origin_col)) / F.lit(1000.0)).drop(origin_col)


def interpolate_at(samples: DataFrame, marks: DataFrame, keys: Sequence[str], ts: str,
                   value: str, at: str, mark_cols: Sequence[str] = (),
                   out: str = "value_at", bucket_ms: int = 7 * 86_400_000) -> DataFrame:
    """Linear interpolation of ``value`` at each mark time ``at``, clamped at
    both ends like ``np.interp`` (JN-6).

    Marks are merged into the sample stream and one ordered scan carries the
    last sample at or before each mark forward and the first sample after it
    backward, so the cost is linear in samples + marks whatever the number
    of marks per key (no sample x mark pairs).
    """
    keys = list(keys)
    mark_cols = list(mark_cols)
    marks = cut(marks, "marks")  # both branches of the scan read them
    pt = F.struct(F.col(ts).cast("double").alias("t"), F.col(value).cast("double").alias("v"))
    s = samples.select(*keys, F.col(ts).cast("double").alias("_t"), F.lit(0).alias("_k"),
                       pt.alias("_s"), *[F.lit(None).cast(marks.schema[c].dataType).alias(c)
                                         for c in [at] + mark_cols])
    m = marks.select(*keys, F.col(at).cast("double").alias("_t"), F.lit(1).alias("_k"),
                     F.lit(None).cast(s.schema["_s"].dataType).alias("_s"), at, *mark_cols)
    # samples sort before marks at equal times: "last at or before" includes them
    sc = scan(s.unionByName(m), keys, "_t", bucket_ms, tiebreak=["_k"], ffill=["_s"],
              bfill=["_s"])
    lo, hi = F.col("ffill__s"), F.col("bfill__s")
    frac = F.try_divide(F.col(at).cast("double") - lo["t"], hi["t"] - lo["t"])
    v = (F.when(lo.isNull(), hi["v"])
          .when(hi.isNull() | (lo["t"] == F.col(at)), lo["v"])
          .otherwise(lo["v"] + frac * (hi["v"] - lo["v"])))
    return sc.filter(F.col("_k") == 1).select(*keys, at, *mark_cols, v.alias(out))


def window_counts(df: DataFrame, keys: Sequence[str], ts: str, width_ms: int,
                  bucket_ms: int, out: str = "n_rows") -> DataFrame:
    """Rows per key and tumbling window of ``width_ms`` (window start in ms),
    plus the running total per key in window order. The count is a partial
    aggregate; the running total is an ordered scan over the (much smaller)
    per-window rows."""
    keys = list(keys)
    start = (F.col(ts) - F.pmod(F.col(ts), F.lit(width_ms))).alias("window_start_ms")
    agg = df.groupBy(*keys, start).agg(F.count(F.lit(1)).alias(out))
    s = scan(agg, keys, "window_start_ms", bucket_ms, cumsum=[out])
    return s.withColumnRenamed(f"cum_{out}", "running_total")
