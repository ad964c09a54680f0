"""Settings that keep a cluster from writing to one machine's disk."""

import pytest

from stridelake import session


class Conf:
    def get(self, key, default=None):
        return default


class Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x",
                                    "local-cluster[3,2,3000]"])
def test_no_private_folder_on_a_cluster(master):
    class Spark:
        conf = Conf()
        sparkContext = Context(master)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Spark())


def test_per_key_side_of_a_join_is_counted(spark, monkeypatch):
    """Under the bound it is broadcast, above it the join is shuffled with a
    written table on that side, which AQE can split against a hot key."""
    from pyspark.sql import functions as F
    rows = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")

    def plan():
        per = session.per_key(rows.groupBy("k").agg(F.max("id").alias("m")))
        df = rows.join(per, "k")
        return df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    monkeypatch.setattr(session.bounded, "__defaults__", (5,))
    text = plan()
    assert "BroadcastHashJoin" not in text and text.count("Exchange hashpartitioning") == 2


def test_a_source_of_many_folders_is_listed_by_few_tasks(spark, tmp_path):
    """Tasks of a listing don't follow the number of folders."""
    for i in range(400):
        (tmp_path / f"trial_id={i}").mkdir()
        (tmp_path / f"trial_id={i}" / "a.csv").write_text("x\n1\n")
    session.configure(spark)
    sc = spark.sparkContext
    sc.setJobGroup("listing", "listing")
    try:
        df = spark.read.schema("x long, trial_id string").csv(str(tmp_path))
        status = sc.statusTracker()
        tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("listing")
                 for s in status.getJobInfo(j).stageIds]
        assert tasks and max(tasks) <= 200
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert df.select("trial_id").distinct().count() == 400
