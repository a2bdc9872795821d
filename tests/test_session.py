from __future__ import annotations

import pytest

from tallyhouse import session
from tallyhouse.sinks import files
from tallyhouse.workload.queries import QUERIES

# These write to the scratch folder while they are built; their parts are covered elsewhere.
EAGER = {n for n in QUERIES if n.startswith(("json_", "daily_job_", "parquet_by", "retention_run"))} | {
    "comprehensive_summary", "merchant_performance_overview", "dedup_across_days", "incremental_summaries",
}


def test_input_size_adds_up_the_tables(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    one = session.input_bytes(events)
    assert one > 10_000
    assert session.input_bytes(events.union(events)) == 2 * one
    assert session.input_bytes(spark.createDataFrame([(1,)], "n int")) < 1 << 20


def test_shuffles_grow_with_the_input(spark, small, monkeypatch):
    events = spark.read.parquet(f"{small}/events.parquet")
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.size_shuffles(events) == floor
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None
    monkeypatch.setattr(session, "SHUFFLE_PARTITION_BYTES", 1000)
    assert session.size_shuffles(events) == -(-session.input_bytes(events) // 1000) > floor
    grouped = events.groupBy("user_id").count()
    assert grouped.count() > 0
    spark.conf.set(session.INITIAL_PARTITIONS, "7")
    with session.sized_shuffles(events) as wanted:
        assert spark.conf.get(session.INITIAL_PARTITIONS) == str(wanted)
    assert spark.conf.get(session.INITIAL_PARTITIONS) == "7"
    spark.conf.unset(session.INITIAL_PARTITIONS)


def test_staging_sizes_its_own_shuffles(spark, small, monkeypatch):
    events = spark.read.parquet(f"{small}/events.parquet")
    monkeypatch.setattr(session, "SHUFFLE_PARTITION_BYTES", 1000)
    seen = []
    sized = session.size_shuffles
    monkeypatch.setattr(session, "size_shuffles", lambda df: seen.append(sized(df)) or seen[-1])
    files.stage(events.groupBy("user_id").count(), "sized")
    assert seen == [-(-session.input_bytes(events) // 1000)]
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None


def test_arithmetic_that_wraps_is_refused(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            session.require_ansi(spark)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    session.require_ansi(spark)


class Context:
    master = "yarn"

    def getCheckpointDir(self):  # noqa: N802
        return None


class Session:
    sparkContext = Context()  # noqa: N815

    def __init__(self, **conf):
        self.conf = {key.replace("_", "."): value for key, value in conf.items()}


def test_scratch_follows_the_configured_folder():
    cluster = Session(spark_checkpoint_dir="hdfs://cluster/scratch/")
    assert session.scratch_root(cluster) == "hdfs://cluster/scratch"


def test_scratch_paths_are_fresh_and_end_with_the_application(spark):
    one, other = session.scratch_path(spark, "a"), session.scratch_path(spark, "a")
    assert one != other
    folder = f"{session.scratch_root(spark)}/{spark.sparkContext.applicationId}"
    assert one.startswith(f"{folder}/a-")
    file_system, path = session.hadoop_path(spark, folder)
    assert file_system.exists(path)
    assert file_system.cancelDeleteOnExit(path)
    file_system.deleteOnExit(path)


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_plans_hold_no_cross_join_and_no_python(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow", "Scan ExistingRDD"):
        assert node not in plan
