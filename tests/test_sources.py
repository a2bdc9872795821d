from __future__ import annotations

import json

import pytest

from tallyhouse.operators import validation as V
from tallyhouse.sources import transactions as S
from tallyhouse.sources.event_tables import read_event_transactions

RECORD = {
    "transaction_id": "in-0007",
    "merchant_id": "shop-3",
    "card_number": "4111111111111000",
    "amount": 59.95,
    "timestamp": "2025-06-24T00:41:05Z",
    "customer_id": "buyer-11",
    "currency": "USD",
    "location": "Norfield",
}


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content))


def record(**change):
    return {**RECORD, **change}


@pytest.fixture
def landing(tmp_path):
    """Three days below ``year=/month=/day=``; the last file of a day is broken."""
    root = tmp_path / "raw"
    put(root / "year=2025/month=06/day=23/a.json", [record(transaction_id="a", timestamp="2025-06-23T12:00:00Z")])
    put(root / "year=2025/month=06/day=24/a.json", [record(transaction_id="b"), record(transaction_id="c", timestamp="2025-06-24T23:59:59Z")])
    put(root / "year=2025/month=06/day=24/b.json", record(transaction_id="d"))
    put(root / "year=2025/month=06/day=24/broken.json", "{ 4111111111111234 ")
    put(root / "year=2025/month=06/day=25/a.json", [record(transaction_id="e", timestamp="2025-06-25T00:00:00Z"), record(transaction_id="f", timestamp="2025-06-25T00:00:01Z")])
    return str(root)


def ids(df):
    return sorted(r.transaction_id for r in df.collect() if r.transaction_id)


def test_a_record(spark, tmp_path):
    put(tmp_path / "x.json", RECORD)
    row = S.read_transactions(spark, str(tmp_path / "x.json")).selectExpr("*", "unix_timestamp(timestamp) AS epoch").first()
    assert (row.transaction_id, row.amount, row.is_corrupt) == ("in-0007", 59.95, False)
    assert row.epoch == 1750725665  # 2025-06-24 00:41:05 UTC


def test_the_instant_is_utc_in_any_session_zone(spark, tmp_path):
    put(tmp_path / "x.json", RECORD)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        epoch = S.read_transactions(spark, str(tmp_path)).selectExpr("unix_timestamp(timestamp)").first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert epoch == 1750725665


def test_one_day_reads_its_own_folder(spark, landing):
    day = S.read_by_date(spark, landing, "2025", "06", "24", "s3")
    assert ids(day) == ["b", "c", "d"]
    assert {(r.year, r.month, r.day) for r in day.collect()} == {(2025, 6, 24)}
    assert all("day=24" in f for f in day.inputFiles())


def test_local_day_file(spark, tmp_path):
    put(tmp_path / "2025_06_24.json", [record(transaction_id="x")])
    assert ids(S.read_by_date(spark, str(tmp_path), 2025, 6, 24, "local")) == ["x"]


def test_unknown_mode_raises(spark):
    with pytest.raises(ValueError, match="unknown mode"):
        S.read_by_date(spark, "/nowhere", 2025, 6, 24, "ftp")


def test_a_broken_file_is_one_flagged_row(spark, landing):
    day = S.read_by_date(spark, landing, 2025, 6, 24, "s3")
    broken = day.filter("is_corrupt").collect()
    assert len(broken) == 1 and broken[0].transaction_id is None
    assert "_corrupt_record" not in day.columns
    flagged = V.flag_transactions(day)
    reasons = [r.validation_errors for r in V.invalid_transactions(flagged).collect()]
    assert len(reasons) == 1 and reasons[0][-1] == "corrupt_record"
    assert ids(V.valid_transactions(flagged)) == ["b", "c", "d"]


def test_several_broken_files_stay_visible(spark, tmp_path):
    for name in "abc":
        put(tmp_path / f"{name}.json", "not json")
    flagged = V.flag_transactions(S.read_transactions(spark, str(tmp_path)))
    assert V.invalid_transactions(flagged).count() == 3


def test_one_bad_field_spoils_only_its_own_row(spark, tmp_path):
    put(tmp_path / "x.json", [record(transaction_id="ok"), record(transaction_id="bad", amount="12.5"), record(transaction_id="nan", amount="NaN")])
    flagged = V.flag_transactions(S.read_transactions(spark, str(tmp_path)))
    errors = {r.transaction_id: r.validation_errors for r in flagged.collect()}
    assert errors == {"ok": [], "bad": ["missing_amount", "amount_out_of_range"], "nan": ["amount_out_of_range"]}


def test_json_lines(spark, tmp_path):
    put(tmp_path / "x.json", "\n".join(json.dumps(record(transaction_id=i)) for i in "ab") + "\n{ broken\n")
    df = S.read_transactions(spark, str(tmp_path), multi_line=False)
    assert ids(df) == ["a", "b"] and df.filter("is_corrupt").count() == 1


def test_date_range_includes_its_last_day(spark, landing):
    assert ids(S.read_date_range(spark, landing, "2025-06-23", "2025-06-24")) == ["a", "b", "c", "d"]
    assert ids(S.read_date_range(spark, landing, "2025-06-25", "2025-06-25")) == ["e", "f"]


def test_date_range_skips_folders(spark, landing):
    df = S.read_date_range(spark, landing, "2025-06-25", "2025-06-25", slack_days=0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :].split("]")[0]
    assert "make_date" in filters
    assert ids(df) == ["e", "f"]


def test_late_records_are_read_unless_pruning_is_asked_for(spark, landing, tmp_path):
    put(tmp_path / "raw/year=2025/month=06/day=25/late.json", record(transaction_id="late", timestamp="2025-06-24T10:00:00Z"))
    assert "late" in ids(S.read_date_range(spark, landing, "2025-06-24", "2025-06-24"))
    assert "late" not in ids(S.read_date_range(spark, landing, "2025-06-24", "2025-06-24", slack_days=0))
    assert "late" in ids(S.read_date_range(spark, landing, "2025-06-24", "2025-06-24", slack_days=1))
    put(tmp_path / "raw/year=2025/month=07/day=25/later.json", record(transaction_id="later", timestamp="2025-06-24T10:00:00Z"))
    assert "later" in ids(S.read_date_range(spark, landing, "2025-06-24", "2025-06-24"))


def test_range_on_a_stored_column_reaches_the_scan(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    plan = S.filter_date_range(events, "2024-01-10", "2024-01-20", "ts")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_availability(spark, landing, tmp_path):
    assert S.data_available(spark, landing)
    assert not S.data_available(spark, str(tmp_path / "nothing"))
    (tmp_path / "empty").mkdir()
    assert not S.data_available(spark, str(tmp_path / "empty"))
    with pytest.raises(Exception, match="unknown-scheme"):
        S.data_available(spark, "unknown-scheme://bucket/path")


def test_event_transactions_have_the_documented_counts(spark, small, medium):
    for folder, raw, deduped, good in ((small, 1000, 980, 800), (medium, 10000, 9800, 8026)):
        flagged = V.flag_transactions(read_event_transactions(spark, folder), order_by=["ingest_seq"], copies_col="copies")
        row = flagged.selectExpr("sum(copies)", "count(*)", "count_if(is_valid)").first()
        assert tuple(row) == (raw, deduped, good)
