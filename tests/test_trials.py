"""FIXTURES B3: the trial event chain on hand-made state series."""

import pytest

from stridelake.operators.trials import trial_events
from stridelake.params import TrialParams

T0 = 1_700_000_000_000


def series(n, seated, past):
    """Frames every 200 ms; ``seated`` / ``past`` are predicates on k."""
    return [(T0 + 200 * k, seated(k), past(k)) for k in range(n)]


NEVER = lambda k: False
CASES = {
    "complete": series(71, lambda k: k < 10 or k >= 65, lambda k: 25 <= k < 40),
    "blip": series(71, lambda k: (k < 10 or k >= 65) and k != 5, lambda k: 25 <= k < 40),
    "false_start": series(51, lambda k: k < 10 or 15 <= k < 25, NEVER),
    "seated": series(51, lambda k: True, NEVER),
    "null": [(T0 + 200 * k, None, None) for k in range(20)],
    "stand_sit": series(51, lambda k: k >= 25, NEVER),
    "no_return": series(51, lambda k: k < 10, lambda k: k >= 25),
    "no_sit": series(61, lambda k: k < 10, lambda k: 25 <= k < 40),
    "at12": series(71, lambda k: k < 10 or k >= 60, lambda k: 25 <= k < 40),
    "under12": series(71, lambda k: k < 10 or k >= 59, lambda k: 25 <= k < 40),
    "restand": series(91, lambda k: k < 10 or 65 <= k < 80, lambda k: 25 <= k < 40),
}
# attempts, finished, frail, duration, stand up, to mark, turn and back, back to chair
EXPECTED = {
    "complete": (1, True, True, 13.0, 2.0, 3.0, 3.0, 5.0),
    "blip": (1, True, True, 13.0, 2.0, 3.0, 3.0, 5.0),
    "false_start": (2, False, None, None, 5.0, None, None, None),
    "seated": (0, False, None, None, None, None, None, None),
    "null": (0, False, None, None, None, None, None, None),
    "stand_sit": (0, False, None, None, None, None, None, None),
    "no_return": (1, False, None, None, 2.0, None, None, None),
    "no_sit": (1, False, None, None, 2.0, None, None, None),
    "at12": (1, True, True, 12.0, 2.0, 3.0, 3.0, 4.0),
    "under12": (1, True, False, 11.8, 2.0, 3.0, 3.0, 3.8),
    "restand": (2, False, None, None, 16.0, None, None, None),
}


@pytest.fixture(scope="module")
def events(spark):
    rows = [(name, ms, s, p) for name, fr in CASES.items() for ms, s, p in fr]
    df = spark.createDataFrame(rows, "trial_id string, frame_ts_ms long, seated boolean, "
                                     "past boolean")
    # tiny buckets so every trial spans several of them
    ev = trial_events(df, TrialParams(bucket_ms=3000))
    return {r.trial_id: r for r in ev.collect()}


@pytest.mark.parametrize("name", list(CASES))
def test_trial_case(events, name):
    r = events[name]
    got = (r.attempts, r.finished, r.frail, r.duration_s, r.stand_up_s, r.to_mark_s,
           r.turn_back_s, r.back_to_chair_s)
    exp = EXPECTED[name]
    assert got[:3] == exp[:3]
    for g, e in zip(got[3:], exp[3:]):
        assert (g is None) == (e is None)
        if e is not None:
            assert g == pytest.approx(e, abs=1e-9)


def test_repeated_frame_times(spark):
    """t4 lies strictly after t3, also where the frame of t3 is there twice."""
    one = [(0, True, False), (1000, False, False), (2000, False, True), (3000, True, False),
           (4000, True, False)]
    twice = one[:4] + one[3:]
    rows = [(n, *r) for n, fr in (("one", one), ("twice", twice), ("all", one + one)) for r in fr]
    df = spark.createDataFrame(rows, "trial_id string, frame_ts_ms long, seated boolean, past boolean")
    for r in trial_events(df, TrialParams()).collect():
        assert (r.t4_ms, r.duration_s, r.turn_back_s, r.back_to_chair_s) == (4000, 4.0, 1.0, 1.0)


def test_every_trial_has_a_row(events):
    assert set(events) == set(CASES)


def test_flagship_plan_has_no_python_and_no_single_partition(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "BatchEvalPython" not in plan
    assert "SinglePartition" not in plan
    assert df.count() > 0


def test_event_chain_over_the_broadcast_limit_writes_each_search(spark):
    from stridelake.operators.trials import event_chain
    from stridelake.session import BROADCAST_MAX_ROWS
    seated = spark.createDataFrame(
        [("a", 1, True, 0, 10), ("a", 2, False, 11, 60), ("a", 3, True, 61, 70), ("b", 1, True, 0, 5)],
        "k string, run_no long, value boolean, t_start long, t_end long")
    past = spark.createDataFrame(
        [("a", 1, False, 0, 20, 1), ("a", 2, True, 21, 40, 22), ("a", 3, False, 41, 70, 42)],
        "k string, run_no long, value boolean, t_start long, t_end long, t_second long")
    few, many = (event_chain(seated, past, "k", n) for n in (10, BROADCAST_MAX_ROWS + 1))
    got = sorted(map(tuple, many.collect()), key=str)
    assert got == sorted(map(tuple, few.collect()), key=str)
    assert ("a", 0, 1, 11, 21, 41, 61) in got
    # the last stage joins what the searches wrote, and holds none of them again
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
