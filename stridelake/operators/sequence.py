"""Ordered per-key scans that do not put one key into one task.

A plain ``Window.partitionBy(trial).orderBy(ts)`` sends every row of a trial
to a single task; one trial may hold a third of all rows. Here each key is
cut into time buckets of fixed width: rows are ordered inside
``(key, bucket)`` by an ordinary window, and what a bucket needs from its
predecessors (last row, running totals, last non-null value, run counters)
comes from a per-bucket summary table with one row per bucket. The summary
is built with a partial aggregate, scanned per key (one small row per
bucket), and joined back on ``(key, bucket)``, which the rows are already
partitioned by. Results equal the single-window version exactly.

Range frames (centred smoothing) use halo rows instead: a row is copied into
the neighbouring bucket when a row there has it inside its frame. Sums over such
frames (``frame_sums``) come from a linear sweep over the frames' ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, per_key

BKT = "_bkt"


#: Bucket of rows without a time: before all others, as nulls sort, and no
#: null itself, so that it is a join key like any other.
NO_TIME = -(1 << 62)


def bucket_of(ts: str | Column, width: int) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.floor(c / F.lit(width)).cast("long"), F.lit(NO_TIME))


def _order(ts: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(ts)] + [F.col(c) for c in tiebreak]


def _okey(ts: str, tiebreak: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in [ts, *tiebreak]])


def scan(df: DataFrame, keys: Sequence[str], ts: str, width: int, *,
         tiebreak: Sequence[str] = (),
         lag: Sequence[str] = (),
         lead: Sequence[str] = (),
         cumsum: Sequence[str] = (),
         ffill: Sequence[str] = (),
         bfill: Sequence[str] = (),
         runs: Sequence[str] = (),
         gaps: dict[str, object] | None = None,
         bucket_col: str | None = None) -> DataFrame:
    """One ordered pass per key.

    Adds, for each name ``c`` requested:

    * ``lag``:    ``prev_c`` (value of the previous row), plus ``has_prev``
    * ``lead``:   ``next_c`` plus ``has_next``
    * ``cumsum``: ``cum_c`` inclusive running sum (nulls count as zero)
    * ``ffill``:  ``ffill_c`` last non-null value up to this row
    * ``bfill``:  ``bfill_c`` first non-null value from this row on
    * ``runs``:   ``run_c`` run number (1-based; a run is a maximal stretch
      of equal values, null-safe equality) and ``start_c`` (first row of run)
    * ``gaps``:   ``{c: g}`` -> ``seg_c`` segment number (1-based; a new
      segment starts where ``c >= previous c + g``) and ``segstart_c``

    ``bucket_col`` names an existing bucket column (same width) so that an
    input already partitioned by ``(keys, bucket)`` is not shuffled again.
    Keys are expected non-null (trial ids always are: an unmatched path gets
    the empty id); rows are ordered by ``ts`` then ``tiebreak``.
    """
    keys = list(keys)
    tiebreak = list(tiebreak)
    gaps = dict(gaps or {})
    # (out suffix, column, "starts a new stretch" given current and previous)
    changes = ([(f"run_{c}", f"start_{c}", c, lambda cur, prev: ~cur.eqNullSafe(prev))
                for c in runs]
               + [(f"seg_{c}", f"segstart_{c}", c,
                   (lambda g: lambda cur, prev: cur >= prev + F.lit(g))(g))
                  for c, g in gaps.items()])
    d = df
    b = bucket_col or BKT
    part = keys + [b]
    if bucket_col is None:
        # One explicit exchange on (key, bucket): the ordered pass and the
        # bucket summary below both read it (the exchange is reused), so the
        # input plan is evaluated once even when scans are stacked.
        d = d.withColumn(b, bucket_of(ts, width)).repartition(*part)
    w = Window.partitionBy(*part).orderBy(*_order(ts, tiebreak))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fromhere = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    okey = _okey(ts, tiebreak)

    inner = []
    if lag or changes:
        inner.append(F.lag(F.lit(True)).over(w).alias("_hp"))
    if lead:
        inner.append(F.lead(F.lit(True)).over(w).alias("_hn"))
    for c in lag:
        inner.append(F.lag(c).over(w).alias(f"_lag_{c}"))
    for c in lead:
        inner.append(F.lead(c).over(w).alias(f"_lead_{c}"))
    for c in cumsum:
        inner.append(F.sum(c).over(upto).alias(f"_cum_{c}"))
    for c in ffill:
        inner.append(F.last(c, ignorenulls=True).over(upto).alias(f"_ff_{c}"))
    for c in bfill:
        inner.append(F.first(c, ignorenulls=True).over(fromhere).alias(f"_bf_{c}"))
    for i, (_, _, c, _) in enumerate(changes):
        inner.append(F.lag(c).over(w).alias(f"_rp_{i}"))
    base = d
    d = d.select("*", *inner)
    for i, (_, _, c, brk) in enumerate(changes):
        # change inside the bucket (the first row of a bucket is settled later)
        chg = F.col("_hp").isNotNull() & F.coalesce(brk(F.col(c), F.col(f"_rp_{i}")), F.lit(False))
        d = d.withColumn(f"_rc_{i}", chg.cast("long"))
        d = d.withColumn(f"_rn_{i}", F.sum(f"_rc_{i}").over(upto))

    # ---- per-bucket summary (one row per key and bucket) -------------------
    aggs = []
    if lag:
        aggs.append(F.max_by(F.struct(*[F.col(c) for c in lag]), okey).alias("_last"))
    if lead:
        aggs.append(F.min_by(F.struct(*[F.col(c) for c in lead]), okey).alias("_first"))
    for c in cumsum:
        aggs.append(F.sum(c).alias(f"_tot_{c}"))
    for c in ffill:
        aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias(f"_lnn_{c}"))
    for c in bfill:
        aggs.append(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias(f"_fnn_{c}"))
    for i, (_, _, c, _) in enumerate(changes):
        aggs += [F.min_by(F.col(c), okey).alias(f"_rf_{i}"),
                 F.max_by(F.col(c), okey).alias(f"_rl_{i}"),
                 F.sum(f"_rc_{i}").alias(f"_ri_{i}")]
    if not aggs:
        return d.drop(*[x for x in d.columns if x.startswith("_") and x not in df.columns])
    # Without run counters the summary needs no window output. (Its branch
    # re-reads the input with fewer columns; callers that follow with a
    # lineage cut hold an expensive input with ``computed_once``.)
    summ = (d if changes else base).groupBy(*part).agg(*aggs)

    wb = Window.partitionBy(*keys).orderBy(b)
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    after = wb.rowsBetween(1, Window.unboundedFollowing)
    carry = []
    if lag:
        carry.append(F.lag("_last").over(wb).alias("_c_last"))
    if lead:
        carry.append(F.lead("_first").over(wb).alias("_c_first"))
    for c in cumsum:
        carry.append(F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0))
                     .alias(f"_c_tot_{c}"))
    for c in ffill:
        carry.append(F.last(f"_lnn_{c}", ignorenulls=True).over(before).alias(f"_c_ff_{c}"))
    for c in bfill:
        carry.append(F.first(f"_fnn_{c}", ignorenulls=True).over(after).alias(f"_c_bf_{c}"))
    idx = range(len(changes))
    s2 = summ.select(*part, *[F.col(f"_rf_{i}") for i in idx],
                     *[F.col(f"_ri_{i}") for i in idx],
                     *[F.lag(f"_rl_{i}").over(wb).alias(f"_rpl_{i}") for i in idx],
                     *([F.lag(F.lit(True)).over(wb).alias("_c_hpb")] if changes else []),
                     *carry)
    for i, (_, _, _, brk) in enumerate(changes):
        # does this bucket's first row start a new stretch?
        s2 = s2.withColumn(
            f"_rb_{i}",
            (F.col("_c_hpb").isNotNull()
             & F.coalesce(brk(F.col(f"_rf_{i}"), F.col(f"_rpl_{i}")), F.lit(False))).cast("long"))
        s2 = s2.withColumn(
            f"_ro_{i}",
            F.coalesce(F.sum(F.col(f"_ri_{i}") + F.col(f"_rb_{i}")).over(before), F.lit(0))
            + F.col(f"_rb_{i}"))
    keep = [x for x in s2.columns if x in part or x.startswith("_c_")
            or x.startswith("_ro_") or x.startswith("_rb_")]
    d = d.join(s2.select(*keep), part, "left")

    out = d
    first_in_bucket = F.col("_hp").isNull() if (lag or changes) else None
    for c in lag:
        out = out.withColumn(f"prev_{c}", F.when(F.col("_hp").isNotNull(), F.col(f"_lag_{c}"))
                             .otherwise(F.col("_c_last")[c]))
    if lag:
        out = out.withColumn("has_prev", F.col("_hp").isNotNull() | F.col("_c_last").isNotNull())
    for c in lead:
        out = out.withColumn(f"next_{c}", F.when(F.col("_hn").isNotNull(), F.col(f"_lead_{c}"))
                             .otherwise(F.col("_c_first")[c]))
    if lead:
        out = out.withColumn("has_next", F.col("_hn").isNotNull() | F.col("_c_first").isNotNull())
    for c in cumsum:
        out = out.withColumn(f"cum_{c}", F.coalesce(F.col(f"_cum_{c}"), F.lit(0))
                             + F.col(f"_c_tot_{c}"))
    for c in ffill:
        out = out.withColumn(f"ffill_{c}", F.coalesce(F.col(f"_ff_{c}"), F.col(f"_c_ff_{c}")))
    for c in bfill:
        out = out.withColumn(f"bfill_{c}", F.coalesce(F.col(f"_bf_{c}"), F.col(f"_c_bf_{c}")))
    for i, (num, start, _, _) in enumerate(changes):
        out = out.withColumn(num, F.col(f"_rn_{i}") + F.col(f"_ro_{i}") + F.lit(1))
        out = out.withColumn(
            start,
            F.when(first_in_bucket,
                   (F.col(f"_rb_{i}") == 1) | F.col("_c_hpb").isNull())
            .otherwise(F.col(f"_rc_{i}") == 1))
    drop = [x for x in out.columns if x.startswith("_") and x not in df.columns]
    if bucket_col is None:
        drop.append(b)
    return out.drop(*[x for x in drop if x != bucket_col])


def halo(df: DataFrame, ts: str, lower: int, upper: int, width: int,
         out: str = BKT) -> DataFrame:
    """Copy each row into every bucket that holds a row whose range frame
    ``[t + lower, t + upper]`` contains it; mark the copy in its own bucket
    with ``_home``. ``width`` must be at least ``upper - lower`` for the
    copies to stay within one bucket on each side.
    """
    t = F.col(ts)
    # its own bucket too, where the frame lies beside the row
    lo = bucket_of(t - F.lit(max(upper, 0)), width)
    hi = bucket_of(t - F.lit(min(lower, 0)), width)
    # a row without a time keeps one copy, in the bucket of such rows (the
    # null peer group of a plain window)
    return (df.withColumn(out, F.explode(F.sequence(lo, hi)))
              .withColumn("_home", F.col(out) == bucket_of(t, width)))


def range_frame(df: DataFrame, keys: Sequence[str], ts: str, lower: int, upper: int,
                width: int, aggs: dict[str, Column], keep_bucket: bool = False) -> DataFrame:
    """``agg OVER (PARTITION BY keys ORDER BY ts RANGE BETWEEN lower AND upper)``
    for every row, computed per (key, bucket) with halo copies.

    ``aggs`` maps output names to window aggregate expressions (without
    ``over``), e.g. ``{"m": F.avg("x")}``. With ``keep_bucket`` the bucket
    column ``_bkt`` stays on the output (home rows only), so a following
    ``scan(..., bucket_col="_bkt")`` reuses the partitioning.
    """
    keys = list(keys)
    d = halo(df, ts, lower, upper, width)
    w = (Window.partitionBy(*keys, BKT).orderBy(F.col(ts))
         .rangeBetween(lower, upper))
    d = d.select("*", *[e.over(w).alias(n) for n, e in aggs.items()])
    d = d.filter(F.col("_home")).drop("_home")
    return d if keep_bucket else d.drop(BKT)


def frame_sums(df: DataFrame, keys: Sequence[str], ts: str, lower: int, upper: int,
               width: int, sums: dict[str, Column], keep_bucket: bool = False) -> DataFrame:
    """``sum(x) OVER (PARTITION BY keys ORDER BY ts RANGE BETWEEN lower AND upper)``
    for every row, in time linear in the rows, however many a frame holds.

    A sweep over frame edges: next to its value a row puts out the two ends of its
    frame as events, one ordered pass carries the running sums, and a frame's sum is
    the difference of the sums at its ends. Rows go to (key, bucket) with halo copies
    as in ``range_frame``, once; the pass and the meeting of a row with its two ends
    stay within the bucket's task.

    ``sums`` maps output names to integer or decimal expressions over the row (floats
    lose digits in the difference); nulls add nothing, and a frame without a value has
    the sum 0. Rows without a time are one frame, as in a plain window.
    """
    keys = list(keys)
    part = [*keys, BKT]
    columns = df.columns
    names = list(sums)
    d = (halo(df.withColumns({f"_x_{n}": e for n, e in sums.items()}), ts, lower, upper, width)
         .repartition(*part))
    low, row, high = F.lit(0), F.lit(1), F.lit(2)

    def event(kind: Column, at: Column) -> Column:
        return F.struct(kind.alias("_kind"), at.alias("_at"))

    t = F.col(ts)
    events = F.when(F.col("_home"), F.array(event(low, t + F.lit(lower)), event(row, t),
                                            event(high, t + F.lit(upper)))
                    ).otherwise(F.array(event(row, t)))
    # an end needs its row's time only
    lean = [F.when(F.col("_e._kind") == row, F.col(c)).alias(c)
            for c in columns if c not in (*keys, ts)]
    d = d.select("*", F.explode(events).alias("_e")).select(
        *part, ts, *lean, "_home", "_e.*",
        *(F.when(F.col("_e._kind") == row, F.col(f"_x_{n}")).alias(f"_x_{n}") for n in names))
    upto = (Window.partitionBy(*part).orderBy("_at", "_kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.select("*", *(F.coalesce(F.sum(f"_x_{n}").over(upto), F.lit(0)).alias(f"_r_{n}")
                        for n in names))
    peers = Window.partitionBy(*part, ts)  # rows of one time have one frame

    def at(kind: Column, n: str) -> Column:
        return F.max(F.when(F.col("_kind") == kind, F.col(f"_r_{n}"))).over(peers)

    d = d.select("*", *((at(high, n) - at(low, n)).alias(n) for n in names))
    return d.where((F.col("_kind") == row) & F.col("_home")).select(
        *columns, *names, *([BKT] if keep_bucket else []))


#: Events (three a time) of one bucket in ``wide_frame_sums``, about.
WIDE_EVENTS = 250_000


def _narrow_width(d: DataFrame, keys: Sequence[str], at: str, width: int) -> int:
    """A width at which no bucket of a key holds much more than ``WIDE_EVENTS`` rows, or
    1: found by counting, as rows may lie close together anywhere."""
    while width > 1:
        most = (d.where(F.col(at).isNotNull()).groupBy(*keys, bucket_of(at, width))
                .agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0])
        if most is None or most <= 2 * WIDE_EVENTS:
            break
        width = max(1, width * WIDE_EVENTS // most)
    return width


def wide_frame_sums(df: DataFrame, keys: Sequence[str], ts: str, lower: int, upper: int,
                    width: int, sums: dict[str, Column]) -> DataFrame:
    """``frame_sums`` for frames wider than a bucket, whose rows no bucket's task should
    hold: a frame's sum is the difference of the key's running sums at its two ends, and
    these come from an ordered scan over buckets made narrow by counting. Rows of one
    time have one frame: values are summed per time first, and the frames' sums joined
    back on it.
    """
    names = list(sums)
    at_row = F.struct(*[F.col(c) for c in keys], F.col(ts))  # equal where nulls are
    x = df.withColumns({f"_x_{n}": e for n, e in sums.items()}).withColumn("_row", at_row)
    per_time = cut(x.groupBy("_row").agg(*(F.sum(f"_x_{n}").alias(f"_x_{n}") for n in names)),
                   "per-time")
    t = F.col("_row")[ts]
    low, row, high = F.lit(0), F.lit(1), F.lit(2)
    ends = F.array(*(F.struct(k.alias("_kind"), a.alias("_at")) for k, a in
                     ((low, t + F.lit(lower)), (row, t), (high, t + F.lit(upper)))))
    e = per_time.select(F.struct(*[F.col("_row")[c].alias(c) for c in keys], F.lit(0).alias("_"))
                        .alias("_key"), "_row", F.explode(ends).alias("_e"),
                        *(f"_x_{n}" for n in names))
    e = e.select("_key", "_row", "_e.*",
                 *(F.when(F.col("_e._kind") == row, F.col(f"_x_{n}")).alias(f"x_{n}")
                   for n in names))
    s = scan(e, ["_key"], "_at", _narrow_width(e, ["_key"], "_at", width), tiebreak=["_kind"],
             cumsum=[f"x_{n}" for n in names])

    def end(kind: Column, n: str) -> Column:
        return F.max(F.when(F.col("_kind") == kind, F.col(f"cum_x_{n}")))

    frames = per_key(s.where(F.col("_kind") != row).groupBy("_row").agg(
        *((end(high, n) - end(low, n)).alias(n) for n in names)), "frames")
    return (df.withColumn("_row", at_row).join(frames, "_row").select(*df.columns, *names))
