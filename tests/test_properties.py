"""Property tests: random series, many keys per example, checked
against brute-force Python versions of the semantics."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stridelake.operators.signals import min_spacing, smooth_flags, state_runs
from stridelake.operators.trials import trial_events
from stridelake.params import TrialParams

SETTINGS = dict(max_examples=6, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture,
                                       HealthCheck.too_slow])

# one key: strictly increasing times (gaps) with two boolean states
series = st.lists(st.tuples(st.integers(1, 700), st.booleans(), st.booleans()),
                  min_size=1, max_size=40)
many = st.lists(series, min_size=1, max_size=6)


def rows_of(keys):
    out = []
    for k, s in enumerate(keys):
        t = 0
        for gap, a, b in s:
            t += gap
            out.append((f"k{k}", t, a, b))
    return out


def brute_smooth(ts, vals, w):
    half = w // 2
    out = []
    for t in ts:
        inside = [v for u, v in zip(ts, vals) if t - half < u <= t + half]
        out.append(sum(inside) / len(inside) > 0.5)
    return out


def brute_runs(ts, vals):
    runs = []
    for t, v in zip(ts, vals):
        if runs and runs[-1][0] == v:
            runs[-1][2] = t
            runs[-1][3] += 1
        else:
            runs.append([v, t, t, 1])
    return runs


def brute_greedy(ts, gap):
    out, last = [], None
    for t in ts:
        if last is None or t >= last + gap:
            out.append(t)
            last = t
    return out


def brute_chain(ts, seated, past, w):
    s, p = brute_smooth(ts, seated, w), brute_smooth(ts, past, w)
    attempts = sum(1 for i in range(1, len(s)) if s[i - 1] and not s[i])
    res = {"attempts": attempts, "t1": None, "t2": None, "t3": None, "t4": None}
    if attempts == 0:
        return res
    res["t1"] = t1 = max(ts[i] for i in range(len(s)) if not s[i] and (i == 0 or s[i - 1]))
    t2 = next((t for t, x in zip(ts, p) if t >= t1 and x), None)
    t3 = None if t2 is None else next((t for t, x in zip(ts, p) if t > t2 and not x), None)
    t4 = None if t3 is None else next((t for t, x in zip(ts, s) if t > t3 and x), None)
    res.update(t2=t2, t3=t3, t4=t4)
    return res


def by_key(rows):
    d = {}
    for k, t, a, b in rows:
        d.setdefault(k, []).append((t, a, b))
    return d


@settings(**SETTINGS)
@given(keys=many, width=st.sampled_from([300, 1000, 5000]))
def test_runs_partition_and_alternate(spark, keys, width):
    rows = rows_of(keys)
    df = spark.createDataFrame(rows, "k string, t long, a boolean, b boolean")
    got = {}
    for r in state_runs(df, ["k"], "t", "a", width).collect():
        got.setdefault(r.k, []).append((r.run_no, r.value, r.t_start, r.t_end, r.n_rows))
    for k, s in by_key(rows).items():
        exp = brute_runs([t for t, _, _ in s], [a for _, a, _ in s])
        runs = sorted(got[k])
        assert [list(x[1:]) for x in runs] == exp
        assert [x[0] for x in runs] == list(range(1, len(exp) + 1))
        assert all(runs[i][1] != runs[i + 1][1] for i in range(len(runs) - 1))


@settings(**SETTINGS)
@given(keys=many, gap=st.sampled_from([1, 200, 650]))
def test_greedy_spacing(spark, keys, gap):
    rows = rows_of(keys)
    df = spark.createDataFrame([(k, t) for k, t, _, _ in rows], "k string, t long")
    got = {}
    for r in min_spacing(df, ["k"], "t", gap).collect():
        got.setdefault(r.k, []).append(r.t)
    for k, s in by_key(rows).items():
        ts = [t for t, _, _ in s]
        kept = sorted(got[k])
        assert kept == brute_greedy(ts, gap)
        assert kept[0] == ts[0] and set(kept) <= set(ts)
        assert all(b - a >= gap for a, b in zip(kept, kept[1:]))


@settings(**SETTINGS)
@given(keys=many, w=st.sampled_from([200, 1000, 3000]))
def test_smoothing_equals_brute_force(spark, keys, w):
    rows = rows_of(keys)
    df = spark.createDataFrame(rows, "k string, t long, a boolean, b boolean")
    got = {(r.k, r.t): r.s_a for r in
           smooth_flags(df, ["k"], "t", ["a"], w, 1500).collect()}
    for k, s in by_key(rows).items():
        ts, vals = [t for t, _, _ in s], [a for _, a, _ in s]
        assert [got[(k, t)] for t in ts] == brute_smooth(ts, vals, w)


@settings(**SETTINGS)
@given(keys=many)
def test_event_chain_equals_brute_force(spark, keys):
    rows = rows_of(keys)
    df = spark.createDataFrame(rows, "trial_id string, frame_ts_ms long, seated boolean, "
                                     "past boolean")
    p = TrialParams(dwell_ms=1000, frail_s=3.0, bucket_ms=1500)
    ev = {r.trial_id: r for r in trial_events(df, p).collect()}
    for k, s in by_key(rows).items():
        ts = [t for t, _, _ in s]
        exp = brute_chain(ts, [a for _, a, _ in s], [b for _, _, b in s], 1000)
        r = ev[k]
        assert r.attempts == exp["attempts"]
        assert r.t0_ms == ts[0]
        assert r.t1_ms == exp["t1"]
        assert r.finished == (exp["t4"] is not None)
        if r.finished:
            t0 = ts[0]
            assert r.duration_s == (exp["t4"] - t0) / 1000.0
            assert r.frail == ((exp["t4"] - t0) / 1000.0 >= 3.0)
            assert t0 <= exp["t1"] <= exp["t2"] < exp["t3"] < exp["t4"]
            assert r.to_mark_s == (exp["t2"] - t0) / 1000.0 - (exp["t1"] - t0) / 1000.0


pts = st.lists(st.tuples(st.integers(1, 400), st.floats(-50, 50, allow_nan=False)),
               min_size=1, max_size=25)


@settings(**SETTINGS)
@given(keys=st.lists(pts, min_size=1, max_size=4),
       marks=st.lists(st.floats(-500, 12000, allow_nan=False), min_size=1, max_size=6))
def test_interpolation_equals_numpy(spark, keys, marks):
    import numpy as np

    from stridelake.operators.signals import interpolate_at
    rows, series = [], {}
    for k, s in enumerate(keys):
        t = 0
        for gap, v in s:
            t += gap
            rows.append((f"k{k}", t, v))
            series.setdefault(f"k{k}", []).append((t, v))
    smp = spark.createDataFrame(rows, "k string, t long, v double")
    mk = spark.createDataFrame([(k, float(m)) for k in series for m in set(marks)],
                               "k string, at double")
    got = {(r.k, r.at): r.value_at for r in
           interpolate_at(smp, mk, ["k"], "t", "v", "at", bucket_ms=700).collect()}
    for k, s in series.items():
        xs, ys = np.array([t for t, _ in s], float), np.array([v for _, v in s])
        for m in set(marks):
            assert got[(k, float(m))] == pytest.approx(float(np.interp(m, xs, ys)), abs=1e-9)


@settings(**SETTINGS)
@given(samples=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5000)), max_size=40),
       sessions=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5000),
                                   st.integers(1, 1500)), max_size=8))
def test_active_session_equals_brute_force(spark, samples, sessions):
    from stridelake.operators.relations import active_session
    x = spark.createDataFrame([(f"k{k}", i, t) for i, (k, t) in enumerate(samples)] or
                              [("z", -1, -10**9)], "k string, sid long, t long")
    s = spark.createDataFrame([(f"k{k}", j, a, a + d) for j, (k, a, d) in enumerate(sessions)] or
                              [("y", -1, 0, 1)], "k string, ses long, a long, b long")
    got = sorted((r.sid, r.ses) for r in active_session(
        x, s, ["k"], "t", "a", "b", 1000, "ses").collect())
    exp = []
    for i, (k, t) in enumerate(samples):  # the last session started, if it still runs
        started = [(a, j, a + d) for j, (k2, a, d) in enumerate(sessions) if k == k2 and a <= t]
        if started and t < max(started)[2]:
            exp.append((i, max(started)[1]))
    assert got == sorted(exp)


@settings(**SETTINGS)
@given(vals=st.lists(st.one_of(st.none(), st.integers(0, 20)), min_size=1, max_size=60))
def test_global_rank_equals_sorted_order(spark, vals):
    from pyspark.sql import functions as F

    from stridelake.operators.relations import global_rank
    df = spark.createDataFrame(list(enumerate(vals)), "id long, d long")
    got = {r.id: r.rank for r in
           global_rank(df, [F.col("d").desc_nulls_last(), F.col("id").asc()], partitions=3)
           .collect()}
    order = sorted(range(len(vals)), key=lambda i: (vals[i] is None, -(vals[i] or 0), i))
    assert got == {i: n + 1 for n, i in enumerate(order)}


@settings(**SETTINGS)
@given(keys=many, width=st.sampled_from([100, 1000]))
def test_window_counts_equal_brute_force(spark, keys, width):
    from stridelake.operators.signals import window_counts
    rows = rows_of(keys)
    df = spark.createDataFrame([(k, t) for k, t, _, _ in rows], "k string, t long")
    got = sorted((r.k, r.window_start_ms, r.n_rows, r.running_total)
                 for r in window_counts(df, ["k"], "t", width, 3 * width).collect())
    exp = []
    for k, s in by_key(rows).items():
        counts = {}
        for t, _, _ in s:
            counts[t - t % width] = counts.get(t - t % width, 0) + 1
        run = 0
        for w in sorted(counts):
            run += counts[w]
            exp.append((k, w, counts[w], run))
    assert got == sorted(exp)


vals_series = st.lists(st.tuples(st.integers(1, 300), st.one_of(st.none(), st.integers(0, 5))),
                       min_size=1, max_size=40)


def rows_vals(keys):
    out = []
    for k, s in enumerate(keys):
        t = 0
        for gap, v in s:
            t += gap
            out.append((f"k{k}", t, v))
    return out


@settings(**SETTINGS)
@given(keys=st.lists(vals_series, min_size=1, max_size=5))
def test_fill_equals_pandas(spark, keys):
    import pandas as pd

    from stridelake.operators.signals import fill_states
    rows = rows_vals(keys)
    df = spark.createDataFrame(rows, "k string, t long, v long")
    got = {(r.k, r.t): r.v for r in fill_states(df, ["k"], "t", ["v"], 500).collect()}
    for k in {r[0] for r in rows}:
        sub = [(t, v) for kk, t, v in rows if kk == k]
        exp = pd.Series([v for _, v in sub], dtype="Float64").ffill().bfill()
        for (t, _), e in zip(sub, exp):
            assert got[(k, t)] == (None if pd.isna(e) else int(e))


@settings(**SETTINGS)
@given(keys=st.lists(vals_series, min_size=1, max_size=5), thr=st.sampled_from([0, 2, 4]))
def test_local_peaks_equal_brute_force(spark, keys, thr):
    from stridelake.operators.signals import local_peaks
    rows = [(k, t, 0 if v is None else v) for k, t, v in rows_vals(keys)]
    df = spark.createDataFrame(rows, "k string, t long, v long")
    got = sorted((r.k, r.t) for r in local_peaks(df, ["k"], "t", "v", thr, 400).collect())
    exp = []
    for k in {r[0] for r in rows}:
        sub = [(t, v) for kk, t, v in rows if kk == k]
        for i in range(1, len(sub) - 1):
            if sub[i][1] > sub[i - 1][1] and sub[i][1] > sub[i + 1][1] and sub[i][1] > thr:
                exp.append((k, sub[i][0]))
    assert got == sorted(exp)


@given(st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.one_of(st.none(), st.integers(0, 900)),
                          st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=60))
@settings(**SETTINGS)
def test_wide_frame_sums_equal_a_plain_window(spark, rows):
    """Frames wider than their buckets; times and keys repeat or are null."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from stridelake.operators import sequence
    d = spark.createDataFrame([(k, t, x, i) for i, (k, t, x) in enumerate(rows)],
                              "k string, t long, x long, i long")
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-120, 200)
    want = d.select("i", F.coalesce(F.sum("x").over(w), F.lit(0)))
    before, sequence.WIDE_EVENTS = sequence.WIDE_EVENTS, 4  # buckets are made narrow
    try:
        got = sequence.wide_frame_sums(d, ["k"], "t", -120, 200, 50, {"s": F.col("x")})
        assert sorted(map(tuple, got.select("i", "s").collect())) == sorted(map(tuple, want.collect()))
    finally:
        sequence.WIDE_EVENTS = before


def test_a_dense_recording_is_smoothed_by_many_small_buckets(spark):
    """All rows lie in one bucket and a frame holds most of them."""
    from pyspark.sql import functions as F

    from stridelake.operators import sequence
    events = spark.range(3000).select(F.lit("all").alias("k"), F.struct("id").alias("_row"),
                                      F.col("id").alias("_at"))
    before, sequence.WIDE_EVENTS = sequence.WIDE_EVENTS, 100
    try:
        width = sequence._narrow_width(events, ["k"], "_at", 100_000)
    finally:
        sequence.WIDE_EVENTS = before
    assert 1 <= width <= 200
