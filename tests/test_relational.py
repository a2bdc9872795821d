"""The staged relational sink, by the calls it makes; there is no database here to run it against."""

from __future__ import annotations

import json

import pytest

from tallyhouse.plans import daily_run
from tallyhouse.sinks.outputs import OutputTarget
from tallyhouse.sinks.relational import RelationalTarget, StagedWriter, write_relational
from tests.rows import transactions

CONNECT = "tests.recorded_database:connect"


def calls(path):
    return [line[2:] for line in map(json.loads, path.read_text().splitlines())]


def statements(path):
    return [call[1] for call in calls(path) if call[0] == "execute"]


def test_tasks_stage_and_one_transaction_moves_all(spark, tmp_path):
    log = tmp_path / "calls"
    df = spark.range(100).selectExpr("id", "array(id) AS list").repartition(8)
    write_relational(df, RelationalTarget(CONNECT, {"calls": str(log)}, num_partitions=3, batch_size=10), "t", keys=["id"])
    made = calls(log)
    staged = [row for call in made if call[0] == "executemany" for row in call[2]]
    assert sorted(row[0] for row in staged) == list(range(100)) and {row[1] for row in staged} == {f"[{i}]" for i in range(100)}
    assert max(len(call[2]) for call in made if call[0] == "executemany") <= 10
    tasks = {row[2] for row in staged}
    assert len(tasks) <= 3
    create, delete, insert, drop = statements(log)
    assert create.startswith("CREATE TABLE t_") and drop.startswith("DROP TABLE t_")
    assert delete.startswith("DELETE FROM t WHERE EXISTS") and "s.id = t.id" in delete and insert.startswith("INSERT INTO t (id, list) SELECT")
    at = [call[1] if call[0] == "execute" else call[0] for call in made].index(delete)
    assert [call[0] for call in made[at : at + 3]] == ["execute", "execute", "commit"]
    assert set(made[at][2]) == set(made[at + 1][2]) == tasks


def test_a_lost_attempt_is_not_taken(tmp_path):
    """Two attempts stage the same rows; only the one whose message arrives is inserted."""
    log = tmp_path / "calls"
    options = {"table": "t", "stage": "t_stage", "keys": "[]", "connect": CONNECT, "settings": json.dumps({"calls": str(log)}), "batch_size": "100"}
    writer = StagedWriter(["id"], options)
    writer.write_as("0-1", [(1,), (2,)])
    again = writer.write_as("0-7", [(1,), (2,)])
    writer.commit([again, None])
    (insert,) = [call for call in calls(log) if call[0] == "execute"]
    assert insert[2] == ["0-7"] and "staged_by IN (%s)" in insert[1]


def test_a_failed_task_leaves_the_table_alone(spark, tmp_path):
    log = tmp_path / "calls"
    df = spark.createDataFrame([("good",), ("bad",)], "name string").repartition(2)
    with pytest.raises(Exception, match="refused"):
        write_relational(df, RelationalTarget(CONNECT, {"calls": str(log), "refuse": "bad"}), "t", keys=["name"])
    assert [s.split(" t")[0] for s in statements(log)] == ["CREATE TABLE", "DROP TABLE"]


def test_a_refused_move_is_rolled_back(spark, tmp_path):
    log = tmp_path / "calls"
    with pytest.raises(Exception, match="refused"):
        write_relational(spark.range(3), RelationalTarget(CONNECT, {"calls": str(log), "refuse": "INSERT INTO t ("}), "t", keys=["id"])
    assert ["rollback"] in calls(log)


def test_the_job_replaces_rows_by_the_keys_of_its_tables(spark, tmp_path):
    log = tmp_path / "calls"
    target = OutputTarget(str(tmp_path / "out"), relational=RelationalTarget(CONNECT, {"calls": str(log)}))
    daily_run.process_transactions(transactions(spark, {}, {"transaction_id": "x", "currency": "XXX"}), target, "2025-06-24")
    deletes = [s for s in statements(log) if s.startswith("DELETE FROM")]
    assert any("processed_transactions" in s and "transaction_id" in s for s in deletes)
    inserts = [s for s in statements(log) if s.startswith("INSERT INTO")]
    assert len(inserts) == 8 and len(deletes) == 7  # invalid rows have no key
