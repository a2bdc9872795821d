"""Summaries that take late records in, against summaries of everything at once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse.contracts import SUMMARY_CONTRACTS
from tallyhouse.operators import metrics
from tallyhouse.operators import validation as V
from tallyhouse.plans.incremental import SummaryStore
from tallyhouse.sinks import files
from tallyhouse.sources.event_tables import DEDUP_ORDER, read_event_transactions


@pytest.fixture(scope="module")
def valid(spark, small):
    flagged = V.flag_transactions(read_event_transactions(spark, small), order_by=DEDUP_ORDER)
    return files.stage(V.valid_transactions(flagged), "valid-small")[0]


def contents(frame):
    return sorted(map(str, frame.drop("summary_generated_at").select(*sorted(set(frame.columns) - {"summary_generated_at"})).collect()))


def assert_whole(spark, store, rows):
    expected = metrics.comprehensive_summary(rows)
    for name in SUMMARY_CONTRACTS:
        columns = [c for c in expected[name].columns if c in store.read(spark, name).columns]
        assert contents(store.read(spark, name).select(*columns)) == contents(expected[name].select(*columns)), name


def test_runs_add_up_and_can_be_repeated(spark, valid, tmp_path):
    store = SummaryStore(str(tmp_path / "store"))
    third = lambda k: valid.filter(F.col("ingest_seq") % 3 == k)
    store.update(third(0), "2024-02-01")
    store.update(third(1), "2024-02-02")
    # The same run again, with other rows: what it brought before is gone, as are dates that had nothing else.
    alone = valid.filter("transaction_date = DATE'2024-01-07' AND ingest_seq % 3 = 2").withColumn("transaction_date", F.lit("2023-12-31").cast("date"))
    assert [str(d) for d in store.update(alone, "2024-02-03")] == ["2023-12-31"]
    touched = store.update(third(2), "2024-02-03")
    assert "2023-12-31" in map(str, touched)
    assert_whole(spark, store, valid)


def test_only_touched_dates_are_read_and_made_again(spark, valid, tmp_path):
    store = SummaryStore(str(tmp_path / "store"))
    late = F.col("transaction_date") == F.lit("2024-01-09").cast("date")
    some = (F.col("ingest_seq") % 2 == 0) & late
    store.update(valid.filter(~some), "2024-02-01")
    before = set(store.read(spark, "risk_metrics").inputFiles())
    assert [str(d) for d in store.update(valid.filter(some), "2024-02-02")] == ["2024-01-09"]
    after = set(store.read(spark, "risk_metrics").inputFiles())
    assert all("_date=2024-01-09" in f for f in before ^ after) and before & after
    read = store._read(spark, "rollup", store.update(valid.filter(some), "2024-02-02"))
    scans = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in scans or "PartitionFilters: [(transaction_date" in scans
    names = {r[0] for r in read.select(F.input_file_name()).distinct().collect()}
    assert {f.split("transaction_date=")[1][:10] for f in names} == {"2024-01-09"}
    assert_whole(spark, store, valid)


def test_a_run_without_rows(spark, valid, tmp_path):
    store = SummaryStore(str(tmp_path / "store"))
    assert store.update(valid.limit(0), "2024-02-01") == []
    store.update(valid, "2024-02-02")
    assert store.update(valid.limit(0), "2024-02-03") == []
    assert_whole(spark, store, valid)
