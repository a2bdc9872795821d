"""Breaches of contracts as rows."""

from __future__ import annotations

from tallyhouse import contracts


def found(frame):
    return {(r.table, r.breach): r.rows for r in frame.collect()}


def runs(spark, *rows):
    return spark.createDataFrame(rows, contracts.RUN_LOG.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))


def run(run_id, status="SUCCESS", date="2025-06-24", mode="batch"):
    import datetime as dt

    moment = dt.datetime(2025, 6, 24)
    return (run_id, date and dt.date.fromisoformat(date), mode, moment, None, status, 1, 1, 0, None, None, moment)


def test_every_breach_is_counted_and_nothing_is_raised(spark):
    frame = runs(spark, run("a"), run("a"), run("a", "ODD"), run("b", date=None), run(None), run(None), run("c", mode="x" * 21))
    assert found(contracts.contract_audit({contracts.RUN_LOG: frame}, lengths=True)) == {
        ("pipeline_processing_logs", "run_id is null"): 2,
        ("pipeline_processing_logs", "processing_date is null"): 1,
        ("pipeline_processing_logs", "status is unknown"): 1,
        ("pipeline_processing_logs", "pipeline_mode is too long"): 1,
        ("pipeline_processing_logs", "key is repeated"): 2,
    }


def test_a_sound_table_and_an_empty_one_have_no_breaches(spark):
    assert found(contracts.contract_audit({contracts.RUN_LOG: runs(spark, run("a"), run("b"))}, lengths=True)) == {}
    assert found(contracts.contract_audit({contracts.RUN_LOG: runs(spark)})) == {}
    every = {r.breach: r.rows for r in contracts.RUN_LOG.breaches(runs(spark)).collect()}
    assert set(every.values()) == {0} and "key is repeated" in every
