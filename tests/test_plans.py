"""Plan shape: no Python workers on analytic paths, no single-task
exchanges, filters and column pruning reach the Parquet scan."""

import pytest

from stridelake.plans import catalogue as C

SF = "/root/testdata/sf0.001"
PY_NODES = ("FlatMapGroupsInPandas", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["trial_events", "state_runs", "quality_tags", "dedup_flags", "state_fill",
                                  "interpolate_marks", "session_samples", "chunk_index"])
def test_no_python_no_single_partition(spark, name):
    plan = plan_of(C.QUERIES[name](spark, SF))
    assert not any(n in plan for n in PY_NODES)
    assert "SinglePartition" not in plan


def test_python_nodes(spark):
    """The detector and the walks of greedy spacing; the latter in Arrow
    batches, spread by (key, bucket)."""
    assert "MapInPandas" in plan_of(C.QUERIES["detect_landmarks"](spark, SF))
    plan = plan_of(C.QUERIES["spaced_peaks"](spark, SF))
    assert "MapInArrow" in plan and "SinglePartition" not in plan
    assert not any(n in plan for n in PY_NODES)


def test_filter_and_columns_reach_the_scan(spark):
    df = C.QUERIES["session_samples"](spark, SF)
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,signup)]" in txt
    assert "value:double" not in txt  # a column of events that nothing here reads


def test_duplicates_without_group_window(spark):
    plan = plan_of(C.QUERIES["dedup_flags"](spark, SF))
    assert "row_number" not in plan


def test_sequence_windows_are_bucketed(spark):
    plan = plan_of(C.QUERIES["state_runs"](spark, SF))
    assert "Window" in plan and "_bkt" in plan


def test_flagship_exchange_budget(spark):
    """Guard against regressions: the final flagship plan (after the run
    table is written) stays within a small, fixed number of shuffles."""
    import re
    plan = plan_of(C.QUERIES["trial_events"](spark, SF))
    shuffles = sum(1 for x in plan.splitlines()
                   if re.search(r"\bExchange (hash|range|round|Single)", x) and "Broadcast" not in x)
    assert shuffles <= 12


def test_run_table_job_is_bucketed(spark):
    """The heavy part of the flagship (smoothing + ordered scan + run
    aggregation) partitions by (trial, bucket) and has no Python."""
    from stridelake.operators.trials import _run_tables, smoothed_states
    from stridelake.sources.tables import event_frames
    st = smoothed_states(event_frames(spark, SF), C.E_TRIAL, tiebreak=["event_id"])
    seated, past, n = _run_tables(st, C.E_TRIAL, "trial_id", "frame_ts_ms", ["event_id"])
    assert n > 0
    from stridelake.operators.sequence import scan
    from stridelake.operators.sequence import BKT
    sc = scan(st, ["trial_id"], "frame_ts_ms", C.E_TRIAL.bucket_ms, tiebreak=["event_id"],
              lead=["frame_ts_ms"], runs=["s_seated", "s_past"], bucket_col=BKT)
    plan = plan_of(sc)
    assert "hashpartitioning(trial_id" in plan and "_bkt" in plan
    assert "SinglePartition" not in plan and not any(p in plan for p in PY_NODES)
