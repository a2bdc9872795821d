from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tallyhouse import contracts
from tallyhouse.contracts import Contract, ContractViolation
from tallyhouse.operators import masking, metrics
from tallyhouse.operators import validation as V
from tallyhouse.sinks import files, jdbc, outputs, run_log
from tallyhouse.sinks.outputs import OutputTarget
from tallyhouse.sources.transactions import read_transactions
from tests.rows import transactions


def dated(spark, *rows):
    return spark.createDataFrame(rows, "id int, date string")


def test_partitioned_overwrite_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(dated(spark, (1, "2025-06-23"), (2, "2025-06-24")), path, ["date"])
    files.write_parquet(dated(spark, (3, "2025-06-24")), path, ["date"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3]


def test_plain_and_rebalanced_writes(spark, tmp_path):
    df = spark.range(1000).repartition(20)
    files.write_parquet(df, str(tmp_path / "a"), rebalance=True)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1000
    files.write_parquet(df, str(tmp_path / "a"), mode="append")
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2000


def test_json_round_trip(spark, tmp_path):
    df = transactions(spark, {}, {"transaction_id": "t2", "amount": None, "timestamp": None})
    files.write_json(df, str(tmp_path / "j"))
    back = read_transactions(spark, str(tmp_path / "j"), multi_line=False).drop("is_corrupt")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_json_keeps_fractions_of_a_second(spark, tmp_path):
    times = ["2025-06-24 00:41:05.123456", "2025-06-24 00:41:05"]
    df = transactions(spark, *[{"transaction_id": str(i)} for i in range(2)])
    df = df.withColumn("timestamp", F.when(F.col("transaction_id") == "0", times[0]).otherwise(times[1]).cast("timestamp"))
    files.write_json(df, str(tmp_path / "j"))
    back = read_transactions(spark, str(tmp_path / "j"), multi_line=False)
    assert [str(r.timestamp) for r in back.orderBy("transaction_id").collect()] == [times[0], times[1]]


def test_partitioned_writes_leave_few_files(spark, tmp_path):
    df = spark.range(800).repartition(8).selectExpr("id", "concat('2025-06-', 10 + id % 10) AS date")
    files.write_parquet(df, str(tmp_path / "t"), ["date"])
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 10


@pytest.mark.parametrize("fmt", files.FORMATS)
def test_replacing_a_day(spark, tmp_path, fmt):
    path, schema = str(tmp_path / "t"), spark.range(1).schema

    def stored():
        return sorted((str(r.date), r.id) for r in files.read_table(spark, path, schema, fmt).collect())

    files.replace_day(spark.range(2), path, "2025-06-23", fmt)
    files.replace_day(spark.range(3), path, "2025-06-24", fmt)
    files.replace_day(spark.range(7, 8), path, "2025-06-24", fmt)
    assert stored() == [("2025-06-23", 0), ("2025-06-23", 1), ("2025-06-24", 7)]
    files.replace_day(spark.range(0), path, "2025-06-24", fmt)
    assert stored() == [("2025-06-23", 0), ("2025-06-23", 1)]


def test_a_failed_write_keeps_the_old_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_day(spark.range(3), path, "2025-06-24")
    bad = spark.range(5).withColumn("id", F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("boom"))))
    with pytest.raises(Exception, match="boom"):
        files.replace_day(bad, path, "2025-06-24", empty=False)
    assert spark.read.parquet(path).count() == 3


def test_absent_tables_read_as_empty_and_formats_are_checked(spark, tmp_path):
    schema = spark.range(1).schema
    assert files.read_table(spark, str(tmp_path / "none"), schema).columns == ["id", "date"]
    with pytest.raises(ValueError, match="unknown format"):
        files.replace_day(spark.range(1), str(tmp_path / "t"), "2025-06-24", "xml")


def test_staging_cuts_the_lineage(spark):
    staged, path = files.stage(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count(), "test")
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "FileScan parquet" in plan
    assert staged.count() == 3
    files.drop_path(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


# JDBC: no database is started here; the calls to Spark's writer are recorded.


def test_nested_columns_become_text(spark):
    df = spark.sql("SELECT 1 AS id, array('b', 'a') AS a, map('k', 1) AS m, named_struct('x', 2) AS s")
    flat = jdbc.flatten_for_jdbc(df)
    assert dict(flat.dtypes) == {"id": "int", "a": "string", "m": "string", "s": "string"}
    assert tuple(flat.first()) == (1, '["b","a"]', '{"k":1}', '{"x":2}')


@pytest.fixture
def sent(monkeypatch):
    calls = []

    def fake(self, url, table, mode=None, properties=None):
        calls.append({"url": url, "table": table, "mode": mode, "properties": properties})

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake)
    return calls


def test_jdbc_options(spark, sent):
    target = jdbc.JdbcTarget("jdbc:x://host/db", {"user": "u"}, num_partitions=3)
    jdbc.write_jdbc(spark.range(1), target, "a")
    jdbc.write_jdbc(spark.range(1), target, "b", mode="overwrite")
    assert [c["mode"] for c in sent] == ["append", "overwrite"]
    assert sent[0]["properties"] == {"user": "u", "batchsize": "10000", "numPartitions": "3", "truncate": "false"}
    assert sent[1]["properties"]["truncate"] == "true"


# Contracts


SAMPLE = Contract(
    "sample", {"k": "string", "n": "int"}, key=("k",), not_null=("n",),
    checks={"n is negative": ("n", "n >= 0")}, lengths={"k": 3},
)


def test_conform_selects_and_casts(spark):
    df = spark.sql("SELECT 'a' AS k, 1.0 AS n, 'x' AS extra")
    assert SAMPLE.conform(df).dtypes == [("k", "string"), ("n", "int")]
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        SAMPLE.conform(df.drop("n"))


@pytest.mark.parametrize(
    ("row", "message"),
    [(("'a'", "-1"), "n is negative"), (("'a'", "NULL"), "n is null"), (("CAST(NULL AS STRING)", "1"), "k is null"), (("'long'", "1"), "k is too long")],
)
def test_enforcement_happens_while_the_rows_are_read(spark, row, message):
    df = spark.sql(f"SELECT {row[0]} AS k, {row[1]} AS n")
    with pytest.raises(Exception, match=message):
        SAMPLE.enforce(df, lengths=True).collect()
    with pytest.raises(ContractViolation, match=message):
        SAMPLE.check(df, lengths=True)


def test_good_rows_pass_and_repeated_keys_are_found(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1), ('b', 0) AS t(k, n)")
    assert SAMPLE.enforce(df, lengths=True).count() == 2
    SAMPLE.check(df, lengths=True)
    with pytest.raises(ContractViolation, match="repeated"):
        SAMPLE.check(df.unionAll(df.limit(1)))


def test_hours_and_percentages_are_bounded(spark):
    hourly = contracts.HOURLY_PATTERNS
    row = spark.sql("SELECT 'm' AS merchant_id, DATE '2025-06-24' AS transaction_date, 24 AS transaction_hour, 1 AS hourly_transactions, 1 AS hourly_amount, 1 AS hourly_avg_amount")
    with pytest.raises(Exception, match="hour is outside"):
        hourly.enforce(row).collect()
    with pytest.raises(Exception, match="percentage is outside"):
        contracts.QUALITY_REPORTS.enforce(
            spark.range(1).selectExpr(*[
                f"{'100.01' if c == 'data_quality_percentage' else repr('2025-06-24') if t in ('date', 'timestamp') else '1'} AS {c}"
                for c, t in contracts.QUALITY_REPORTS.columns.items()
            ])
        ).collect()


def test_quality_report_row(spark, tmp_path):
    quality = spark.sql("SELECT 10L AS raw_transactions, 6L AS valid_transactions, 2L AS invalid_transactions, 8L AS total_transactions, 60.00BD AS pct_of_raw, 75.00BD AS data_quality_percentage")
    target = OutputTarget(str(tmp_path))
    for _ in range(2):
        outputs.write_quality_report(quality, target, "2025-06-24", run_log.utc_now(), 3)
    row = outputs.read_output(spark, target, contracts.QUALITY_REPORTS).collect()
    assert len(row) == 1
    assert (row[0].processing_date, row[0].data_quality_percentage) == (dt.date(2025, 6, 24), Decimal("75.00"))


def test_named_writers(spark, tmp_path):
    df = transactions(spark, {}, {"transaction_id": "t2", "amount": None}).withColumn("created_at", F.current_timestamp())
    flagged = V.flag_transactions(df)
    valid, target = V.valid_transactions(flagged), OutputTarget(str(tmp_path))
    outputs.write_processed(masking.apply_all_masking(valid), target, "2025-06-24")
    outputs.write_invalid(masking.mask_card_number(V.invalid_transactions(flagged)), target, "2025-06-24")
    outputs.write_summaries(metrics.comprehensive_summary(valid), target, "2025-06-24")
    for contract in (contracts.PROCESSED, contracts.INVALID, *contracts.SUMMARY_CONTRACTS.values()):
        assert outputs.read_output(spark, target, contract).count() == 1
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        outputs.write_invalid(V.invalid_transactions(flagged), target, "2025-06-24")


def test_run_log_keeps_one_row_per_run(spark, tmp_path):
    target = OutputTarget(str(tmp_path))
    run = run_log.Run(dt.date(2025, 6, 24), "s3")
    run_log.record_run(spark, target, run)
    assert run_log.read_run_log(spark, target).first().status == "RUNNING"
    run_log.record_run(spark, target, run.ended("FAILED", "it's broken"))
    rows = run_log.read_run_log(spark, target).collect()
    assert [(r.status, r.error_message) for r in rows] == [("FAILED", "it's broken")]
    with pytest.raises(Exception, match="status is unknown"):
        run_log.record_run(spark, target, run.ended("DONE"))
