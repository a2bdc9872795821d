from __future__ import annotations

import datetime as dt
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tallyhouse import __main__ as cli
from tallyhouse import contracts
from tallyhouse.functions import rules as R
from tallyhouse.operators.cleaning import clean_transactions
from tallyhouse.plans import daily_run
from tallyhouse.plans.incremental import SummaryStore
from tallyhouse.plans.result_views import register_views
from tallyhouse.plans.retention import cleanup_old_data
from tallyhouse.session import scratch_path
from tallyhouse.sinks import outputs
from tallyhouse.sinks.jdbc import JdbcTarget
from tallyhouse.sinks.landed_ids import LandedIds
from tallyhouse.sinks.outputs import OutputTarget
from tallyhouse.sinks.run_log import read_run_log
from tallyhouse.sources.event_tables import DEDUP_ORDER, read_event_transactions
from tests.rows import transactions
from tests.test_sources import put, record

DAY = "2025-06-24"
STORED = [
    contracts.PROCESSED, contracts.INVALID, *contracts.SUMMARY_CONTRACTS.values(), contracts.QUALITY_REPORTS,
]


@pytest.fixture(scope="module")
def done(spark, small, tmp_path_factory):
    target = OutputTarget(str(tmp_path_factory.mktemp("out")))
    raw = read_event_transactions(spark, small)
    result = daily_run.process_transactions(raw, target, DAY, order_by=DEDUP_ORDER)
    return target, result, raw


def stored_rows(spark, target, contract):
    volatile = [c for c in ("created_at", "summary_generated_at", "processing_duration_seconds") if c in contract.columns]
    return sorted(map(str, outputs.read_output(spark, target, contract).drop(*volatile).collect()))


def test_result(done):
    _, result, _ = done
    assert (result.raw_count, result.valid_count, result.invalid_count, result.summaries_generated) == (1000, 800, 180, 5)
    assert result.data_quality_percentage == pytest.approx(80.0)
    report = daily_run.processing_report(result)
    assert "read 1000" in report and "800 valid (80.00 %" in report and "180 invalid" in report
    assert result.repeats_removed == 20


def test_a_session_outside_utc_is_refused(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(RuntimeError, match="time zone"):
            daily_run.process_transactions(transactions(spark, {}), OutputTarget(str(tmp_path)), DAY)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_quality_report_names_the_errors(spark, done):
    target, _, _ = done
    report = outputs.read_output(spark, target, contracts.QUALITY_REPORTS).first()
    errors = json.loads(report.errors_encountered)
    assert list(errors) == sorted(errors) and errors["missing_amount"] == 25
    assert report.raw_transactions == 1000


def test_every_table_meets_its_contract(spark, done):
    target, _, _ = done
    for contract in STORED:
        frame = outputs.read_output(spark, target, contract)
        assert frame.columns == [*contract.columns, "date"]
        contract.check(frame, lengths=True)
    contracts.RUN_LOG.check(read_run_log(spark, target))


def test_totals_agree(spark, done):
    target, result, _ = done
    views = register_views(spark, target)
    assert views["processed_transactions"].count() == result.valid_count
    assert views["invalid_transactions"].count() == result.invalid_count
    for table, column in (
        ("summary_daily_merchant_summary", "total_transactions"),
        ("summary_hourly_patterns", "hourly_transactions"),
        ("summary_currency_breakdown", "currency_transactions"),
        ("summary_merchant_kpis", "transaction_count"),
        ("daily_transaction_summary", "total_transactions"),
    ):
        assert views[table].agg(F.sum(column)).first()[0] == result.valid_count


def test_no_card_number_is_stored_anywhere(spark, done):
    target, _, _ = done
    for contract in STORED:
        for row in outputs.read_output(spark, target, contract).drop("transaction_hash", "customer_id_hash").collect():
            assert not re.search(r"4111\D?1111\D?1111", str(row))
    assert "customer_id" not in contracts.PROCESSED.columns


def test_running_again_changes_nothing(spark, done):
    target, _, raw = done
    before = {c.table: stored_rows(spark, target, c) for c in STORED}
    daily_run.process_transactions(raw.repartition(5), target, DAY, order_by=DEDUP_ORDER)
    for contract in STORED:
        assert stored_rows(spark, target, contract) == before[contract.table]
    assert [r.status for r in read_run_log(spark, target).collect()] == ["SUCCESS", "SUCCESS"]


def test_scratch_tables_are_removed(spark, tmp_path):
    folder = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    before = set(folder.glob("*"))
    daily_run.process_transactions(transactions(spark, {}), OutputTarget(str(tmp_path)), DAY)
    assert set(folder.glob("*")) == before


def test_other_days_stay_and_a_clean_rerun_clears_invalid_rows(spark, tmp_path):
    target = OutputTarget(str(tmp_path), "json")
    bad = {"transaction_id": "t2", "amount": None}
    daily_run.process_transactions(transactions(spark, {}), target, "2025-06-23")
    daily_run.process_transactions(transactions(spark, {}, bad), target, DAY)
    invalid = lambda: outputs.read_output(spark, target, contracts.INVALID).count()
    assert invalid() == 1
    daily_run.process_transactions(transactions(spark, {}), target, DAY)
    assert invalid() == 0
    days = outputs.read_output(spark, target, contracts.PROCESSED).groupBy("date").count().collect()
    assert sorted((str(r.date), r["count"]) for r in days) == [("2025-06-23", 1), (DAY, 1)]


def test_a_day_without_records(spark, tmp_path):
    target = OutputTarget(str(tmp_path))
    result = daily_run.process_transactions(transactions(spark, {}).limit(0), target, DAY)
    assert (result.raw_count, result.data_quality_percentage) == (0, 0.0)
    report = outputs.read_output(spark, target, contracts.QUALITY_REPORTS).first()
    assert (report.total_transactions, report.errors_encountered) == (0, None)


def test_failures_are_loud_and_logged(spark, tmp_path):
    target = OutputTarget(str(tmp_path))
    df = transactions(spark, {})
    broken = R.Rule("broken", F.raise_error(F.lit("rule broke")).isNull())
    rules = [*R.standard_rules(clean_transactions(df).schema), broken]
    with pytest.raises(Exception, match="rule broke"):
        daily_run.process_transactions(df, target, DAY, rules=rules)
    row = read_run_log(spark, target).first()
    assert row.status == "FAILED" and "rule broke" in row.error_message and row.end_time is not None


# The columns of the relational tables that a run appends to.
DATABASE_COLUMNS = {
    "processed_transactions": "transaction_id merchant_id amount currency timestamp customer_id_hash location transaction_date transaction_hour completeness_score transaction_hash created_at",
    "invalid_transactions": "transaction_id merchant_id card_number amount currency timestamp customer_id location transaction_date validation_errors created_at",
    "data_quality_reports": "processing_date valid_transactions invalid_transactions total_transactions data_quality_percentage processing_duration_seconds errors_encountered created_at",
}


def test_relational_copies(spark, tmp_path, monkeypatch):
    sent = {}

    def receive(self, url, table, mode=None, properties=None):
        sent[table] = (dict(self._df.dtypes), self._df.collect())

    monkeypatch.setattr(DataFrameWriter, "jdbc", receive)
    target = OutputTarget(str(tmp_path), jdbc=JdbcTarget("jdbc:x://host/db"))
    daily_run.process_transactions(transactions(spark, {}, {"transaction_id": "t2", "amount": None}), target, DAY)
    assert set(sent) == {*DATABASE_COLUMNS, *(f"summary_{name}" for name in contracts.SUMMARY_CONTRACTS)}
    for table, columns in DATABASE_COLUMNS.items():
        assert sorted(sent[table][0]) == sorted(columns.split())
    assert all(kind != "array<string>" for types, _ in sent.values() for kind in types.values())
    row = sent["invalid_transactions"][1][0]
    assert row.card_number == "************1234"
    assert json.loads(row.validation_errors) == ["missing_amount", "amount_out_of_range"]


def test_a_failed_relational_copy_is_partial(spark, tmp_path, monkeypatch):
    tried = []

    def refuse(self, table, **_):
        tried.append(table)
        raise ConnectionError("no database")

    monkeypatch.setattr(DataFrameWriter, "jdbc", refuse)
    target = OutputTarget(str(tmp_path), jdbc=JdbcTarget("jdbc:x://host/db"))
    with pytest.raises(daily_run.DatabaseError, match="processed_transactions.*summary_risk_metrics|risk_metrics"):
        daily_run.process_transactions(transactions(spark, {}), target, DAY)
    assert len(tried) == 8  # a refusal does not keep the other tables from being sent
    assert read_run_log(spark, target).first().status == "PARTIAL"
    assert outputs.read_output(spark, target, contracts.PROCESSED).count() == 1


def test_a_broken_contract_while_writing_is_partial(spark, tmp_path, monkeypatch):
    strict = {"amount is odd": ("hourly_amount", "hourly_amount < 0")}
    monkeypatch.setitem(contracts.HOURLY_PATTERNS.checks, *strict.popitem())
    target = OutputTarget(str(tmp_path))
    with pytest.raises(Exception, match="hourly_patterns: amount is odd"):
        daily_run.process_transactions(transactions(spark, {}), target, DAY)
    assert read_run_log(spark, target).first().status == "PARTIAL"
    assert outputs.read_output(spark, target, contracts.HOURLY_PATTERNS).isEmpty()


def test_views_answer_sql(spark, done):
    target, _, _ = done
    register_views(spark, target)
    rows = spark.sql("SELECT quality_status FROM data_quality_monitoring").collect()
    assert [r.quality_status for r in rows] == ["NEEDS_ATTENTION"]
    overview = spark.sql("SELECT count(*), count(risk_level) FROM merchant_performance_overview").first()
    assert tuple(overview) == (198, 198)


def test_overview_matches_within_a_processing_date(spark, tmp_path):
    """A late record makes the same merchant-day appear on two processing dates."""
    target = OutputTarget(str(tmp_path))
    for day in (DAY, "2025-06-25"):
        daily_run.process_transactions(transactions(spark, {}), target, day)
    assert register_views(spark, target)["merchant_performance_overview"].count() == 2


def test_retention(spark, tmp_path):
    target = OutputTarget(str(tmp_path))
    bad = transactions(spark, {}, {"transaction_id": "t2", "amount": None}, {"transaction_id": "t3", "currency": "?"})
    for day in ("2025-06-23", DAY):
        daily_run.process_transactions(bad, target, day)
    # Age one row of one day, so that this day is rewritten and the other is left alone.
    path = target.path(contracts.INVALID)
    rows = outputs.read_output(spark, target, contracts.INVALID).filter(F.col("date") == DAY)
    aged = rows.withColumn(
        "created_at",
        F.when(F.col("transaction_id") == "t2", F.col("created_at") - F.expr("INTERVAL 40 DAYS")).otherwise(F.col("created_at")),
    ).collect()
    from tallyhouse.sinks import files

    files.replace_day(spark.createDataFrame(aged, rows.schema).drop("date"), path, DAY)
    assert cleanup_old_data(spark, target, 30) == {"invalid_transactions": 1, "pipeline_processing_logs": 0}
    left = outputs.read_output(spark, target, contracts.INVALID).collect()
    assert sorted((str(r.date), r.transaction_id) for r in left) == [("2025-06-23", "t2"), ("2025-06-23", "t3"), (DAY, "t3")]

    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=31)
    assert cleanup_old_data(spark, target, 30, later) == {"invalid_transactions": 3, "pipeline_processing_logs": 2}
    assert outputs.read_output(spark, target, contracts.INVALID).isEmpty()
    assert read_run_log(spark, target).isEmpty()
    assert outputs.read_output(spark, target, contracts.PROCESSED).count() == 2


def arguments(tmp_path, mode):
    return ["--mode", mode, "--year", "2025", "--month", "06", "--day", "24", "--raw", str(tmp_path / "raw"), "--out", str(tmp_path / "out")]


@pytest.fixture
def shared_session(spark, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    return spark


@pytest.mark.parametrize("mode", ["s3", "local"])
def test_command_line(shared_session, tmp_path, mode):
    records = [record(transaction_id="a"), record(transaction_id="a"), record(transaction_id="b", currency="?")]
    name = "2025_06_24.json" if mode == "local" else "year=2025/month=06/day=24/x.json"
    put(tmp_path / "raw" / name, records)
    assert cli.main(arguments(tmp_path, mode)) == 0
    target = OutputTarget(str(tmp_path / "out"))
    report = outputs.read_output(shared_session, target, contracts.QUALITY_REPORTS).first()
    assert (report.raw_transactions, report.valid_transactions, report.invalid_transactions) == (3, 1, 1)
    assert read_run_log(shared_session, target).first().pipeline_mode == mode


def test_a_missing_day_gives_exit_code_one_and_a_failed_run(shared_session, tmp_path):
    assert cli.main(arguments(tmp_path, "s3")) == 1
    row = read_run_log(shared_session, OutputTarget(str(tmp_path / "out"))).first()
    assert row.status == "FAILED" and "PATH_NOT_FOUND" in row.error_message


def test_command_line_needs_its_arguments():
    with pytest.raises(SystemExit):
        cli.parse_arguments(["--mode", "s3"])
    with pytest.raises(SystemExit):
        cli.parse_arguments(["--mode", "ftp", "--year", "1", "--month", "1", "--day", "1", "--raw", "a", "--out", "b"])


def test_merchant_summary_as_a_table_function(spark, done):
    target, _, _ = done
    register_views(spark, target)
    busiest = spark.sql("SELECT merchant_id, count(*) AS days FROM summary_daily_merchant_summary GROUP BY 1 ORDER BY 2 DESC, 1").first()
    rows = spark.sql(f"SELECT * FROM get_merchant_summary('{busiest.merchant_id}', DATE'2024-01-01', DATE'2024-12-31')")
    assert rows.count() == busiest.days and rows.columns[0] == "merchant_id"


def test_records_of_earlier_days_are_not_taken_again(spark, tmp_path):
    target, landed = OutputTarget(str(tmp_path / "out")), LandedIds(str(tmp_path / "landed"))
    first = transactions(spark, {"transaction_id": " a "}, {"transaction_id": "bad", "currency": "XXX"})
    daily_run.process_transactions(first, target, "2025-06-24", landed=landed)
    # A record that was invalid may be sent again; one that was stored is not taken twice.
    again = transactions(spark, {"transaction_id": "a"}, {"transaction_id": "bad"}, {"transaction_id": "new"})
    for _ in range(2):  # and a day can be run again
        result = daily_run.process_transactions(again, target, "2025-06-25", landed=landed)
        assert (result.raw_count, result.valid_count, result.invalid_count) == (2, 2, 0)
    stored = outputs.read_output(spark, target, contracts.PROCESSED).collect()
    assert sorted((r.transaction_id, str(r.date)) for r in stored) == [("a", "2025-06-24"), ("bad", "2025-06-25"), ("new", "2025-06-25")]


def test_observed_counts_are_those_of_the_stored_rows(spark, done):
    target, result, _ = done
    row = outputs.read_output(spark, target, contracts.QUALITY_REPORTS).first()
    stored = [outputs.read_output(spark, target, c).count() for c in (contracts.PROCESSED, contracts.INVALID)]
    assert [row.valid_transactions, row.invalid_transactions] == stored == [result.valid_count, result.invalid_count]
    assert row.raw_transactions == result.raw_count and row.total_transactions == sum(stored)


def test_late_records_reach_the_summaries_of_their_own_day(spark, tmp_path):
    target, store = OutputTarget(str(tmp_path / "out")), SummaryStore(str(tmp_path / "summaries"))
    late = {"transaction_id": "late", "amount": 7.5, "customer_id": "c2"}
    for day, rows in (("2025-06-24", [{}]), ("2025-06-25", [late, {"transaction_id": "n", "timestamp": dt.datetime(2025, 6, 25, 9)}])):
        daily_run.process_transactions(transactions(spark, *rows), target, day, summary_store=store)
    found = {str(r.transaction_date): r for r in store.read(spark, "daily_merchant_summary").collect()}
    assert {d: (r.total_transactions, float(r.total_amount)) for d, r in found.items()} == {"2025-06-24": (2, 20.0), "2025-06-25": (1, 12.5)}
    assert {str(r.transaction_date): r.unique_customers for r in store.read(spark, "risk_metrics").collect()} == {"2025-06-24": 2, "2025-06-25": 1}
