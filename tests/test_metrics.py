from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import metrics, reports
from tallyhouse.operators import validation as V
from tests.rows import many, transactions


def valid(df):
    return V.valid_transactions(V.flag_transactions(df))


def test_single_transaction_day(spark):
    df = valid(transactions(spark, {"amount": 50.0}))
    summary = metrics.daily_merchant_summary(df).first()
    assert summary.total_transactions == 1
    assert summary.std_transaction_amount is None
    assert summary.total_amount == summary.avg_transaction_amount == Decimal("50.00")
    assert (summary.currencies_used, summary.locations, summary.active_hours) == (["USD"], ["Norfield"], ["00"])
    risk = metrics.risk_metrics(df).first()
    assert (risk.max_transaction_ratio, risk.risk_score, risk.risk_level) == (Decimal("1.0000"), 7, "MEDIUM")


def test_summary_counts_customers_with_repeats(spark):
    df = valid(many(spark, 10, customer_id="concat('c', id % 2)", timestamp="TIMESTAMP '2025-06-24 00:00:00' + make_dt_interval(0, id)"))
    row = metrics.daily_merchant_summary(df).first()
    assert row.total_customers == 10
    assert row.active_hours == [f"{h:02d}" for h in range(10)]
    assert row.active_hour_count == 10
    assert (row.first_transaction_time.hour, row.last_transaction_time.hour) == (0, 9)
    assert metrics.customer_reach(df).first().unique_customers == 2


def score(spark, amounts):
    """Risk score of one merchant-day with these (count, amount) groups."""
    values = ", ".join(f"({n}, CAST({a} AS DOUBLE))" for n, a in amounts)
    groups = spark.sql(f"SELECT explode(sequence(1, n)) AS k, a FROM VALUES {values} AS g(n, a)")
    ids = groups.select(F.concat(F.lit("t"), "a", "k").alias("transaction_id"), F.col("a").alias("amount"))
    rest = transactions(spark, {}).drop("transaction_id", "amount")
    columns = [F.lit(v).alias(c) for c, v in rest.first().asDict().items()]
    row = metrics.risk_metrics(valid(ids.select("*", *columns))).first()
    return row.risk_score


@pytest.mark.parametrize(
    ("amounts", "expected"),
    [
        ([(5, 5000.01)], 3),
        ([(6, 5000.01)], 10),
        ([(6, 5000)], 3),
        ([(10, 1000.01)], 3),
        ([(11, 1000.01)], 8),
        ([(11, 1000)], 3),
        ([(100, 1)], 3),
        ([(101, 1)], 6),
        ([(101, 1), (1, 900)], 6),
        ([(1, 80), (1, 20)], 3),
        ([(1, 80.01), (1, 20)], 7),
        ([(6, 5000.01), (101, 1)], 10),
    ],
)
def test_risk_cascade_takes_the_first_match(spark, amounts, expected):
    assert score(spark, amounts) == expected


def test_levels(spark):
    from tallyhouse.functions.scoring import risk_level

    rows = spark.createDataFrame([(s,) for s in (3, 6, 7, 8, 10)], "s int").select("s", risk_level(F.col("s")).alias("l"))
    assert dict(map(tuple, rows.collect())) == {3: "LOW", 6: "MEDIUM", 7: "MEDIUM", 8: "HIGH", 10: "HIGH"}


@pytest.fixture(scope="module")
def busy(spark):
    return valid(
        many(
            spark, 3000,
            merchant_id="CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('m', id % 17) END",
            amount="CAST(((id * 7919) % 999999 + 1) / 100 AS DOUBLE)",
            timestamp="TIMESTAMP '2025-06-24 00:00:00' + make_dt_interval(id % 2, id % 24)",
            customer_id="concat('c', id % 101)",
            currency="element_at(array('USD', 'EUR', 'GBP'), CAST(id % 3 + 1 AS INT))",
            location="concat('L', id % 29)",
        )
    ).persist()


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_shared_and_direct_forms_agree(busy):
    shared = metrics.comprehensive_summary(busy)
    undated = lambda df: df.drop("summary_generated_at")
    assert same(undated(shared["daily_merchant_summary"]), undated(metrics.daily_merchant_summary(busy)))
    assert same(shared["risk_metrics"], metrics.risk_metrics(busy))
    assert same(shared["hourly_patterns"], metrics.hourly_patterns(busy))
    assert same(shared["currency_breakdown"], metrics.currency_breakdown(busy))
    assert same(shared["merchant_kpis"], metrics.merchant_kpis(busy))
    grades = metrics.risk_grades(metrics.merchant_day(metrics.activity_rollup(busy)))
    assert same(grades, shared["risk_metrics"].select(grades.columns))


def test_totals_agree_across_summaries(busy):
    rows = busy.count()
    money = busy.agg(F.sum("amount")).first()[0]
    for frame, count, amount in (
        (metrics.daily_merchant_summary(busy), "total_transactions", "total_amount"),
        (metrics.hourly_patterns(busy), "hourly_transactions", "hourly_amount"),
        (metrics.currency_breakdown(busy), "currency_transactions", "currency_amount"),
        (metrics.merchant_kpis(busy), "transaction_count", "gross_volume"),
        (reports.daily_transaction_summary(busy), "total_transactions", "total_volume"),
    ):
        found = frame.agg(F.sum(count), F.sum(amount)).first()
        assert (found[0], found[1]) == (rows, money)


def test_results_do_not_depend_on_partitioning(busy):
    one, other = (metrics.daily_merchant_summary(d).drop("summary_generated_at") for d in (busy.coalesce(1), busy.repartition(13)))
    assert same(one, other)


def test_rows_meet_per_merchant_day_only_after_the_rollup(busy):
    """The exchange below the merchant-day one is keyed on all four rollup columns."""
    plan = metrics.daily_merchant_summary(busy)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][:2]
    assert "location" not in exchanges[0] and "location" in exchanges[1]
    below = plan[plan.index(exchanges[1]) :]
    assert "HashAggregate" in below and "ObjectHashAggregate" not in below


def test_risk_counts_copy_only_reduced_rows(busy):
    """The two distinct counts expand rows; below them customers and locations are reduced already."""
    plan = metrics.risk_metrics(busy)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Expand") :]
    assert "Expand" not in below[6:] and "HashAggregate" in below and "_customer" in below.split("Exchange")[0]


def test_both_forms_of_risk_keep_rows_without_a_merchant(spark):
    df = transactions(spark, {}, {"transaction_id": "t2", "merchant_id": None}, {"transaction_id": "t3", "merchant_id": None})
    valid = V.flag_transactions(df)
    day = metrics.with_reach(metrics.merchant_day(metrics.activity_rollup(valid)), metrics.customer_reach(valid))
    shared, direct = metrics.risk_from_day(day), metrics.risk_metrics(valid)
    assert same(shared, direct) and direct.where("merchant_id is null").first().transaction_velocity == 2


def test_quality_percentages(spark):
    df = transactions(spark, {}, {}, {"transaction_id": "t2"}, {"transaction_id": "t3", "amount": None})
    row = metrics.data_quality_summary(V.flag_transactions(df, copies_col="copies")).first()
    assert (row.raw_transactions, row.valid_transactions, row.invalid_transactions, row.total_transactions) == (4, 2, 1, 3)
    assert (row.pct_of_raw, row.data_quality_percentage) == (Decimal("50.00"), Decimal("66.67"))


def test_quality_of_nothing_is_zero(spark):
    empty = V.flag_transactions(transactions(spark, {}).limit(0), copies_col="copies")
    row = metrics.data_quality_summary(empty).first()
    assert (row.raw_transactions, row.pct_of_raw, row.data_quality_percentage) == (0, Decimal("0.00"), Decimal("0.00"))


def test_overview_keeps_days_without_risk(spark, busy):
    summary, risk = metrics.daily_merchant_summary(busy), metrics.risk_metrics(busy).filter("merchant_id <> 'hot'")
    rows = reports.merchant_performance_overview(summary, risk).collect()
    assert len(rows) == summary.count()
    assert {r.risk_level for r in rows if r.merchant_id == "hot"} == {None}
    assert [(r.transaction_date, r.total_amount) for r in rows] == sorted(
        ((r.transaction_date, r.total_amount) for r in rows), reverse=True
    )


@pytest.mark.parametrize(
    ("n", "amount", "category"),
    [(101, 10000.01, "HIGH_VOLUME"), (101, 10000, "MEDIUM_VOLUME"), (51, 5000.01, "MEDIUM_VOLUME"), (50, 99999, "LOW_VOLUME"), (101, 5000, "LOW_VOLUME")],
)
def test_volume_category(spark, n, amount, category):
    from tallyhouse.functions.scoring import volume_category

    assert spark.range(1).select(volume_category(F.lit(n), F.lit(amount))).first()[0] == category


def test_quality_status(spark):
    rows = spark.createDataFrame([("2025-06-0%d" % i, 10, 9, 1, p) for i, p in enumerate((95.0, 90.0, 85.0, 84.99), 1)],
        "processing_date string, total_transactions int, valid_transactions int, invalid_transactions int, data_quality_percentage double")
    found = reports.data_quality_monitoring(rows).collect()
    assert [r.quality_status for r in found] == ["NEEDS_ATTENTION", "ACCEPTABLE", "GOOD", "EXCELLENT"]


def test_merchant_summary_includes_both_ends(spark, busy):
    summary = metrics.daily_merchant_summary(busy)
    rows = reports.get_merchant_summary(summary, "hot", "2025-06-24", dt.date(2025, 6, 25)).collect()
    assert [str(r.transaction_date) for r in rows] == ["2025-06-24", "2025-06-25"]
    assert reports.get_merchant_summary(summary, "hot", "2025-06-25", "2025-06-25").count() == 1
    assert len(rows[0]) == 8


def test_retention_keeps_the_cutoff_and_undated_rows(spark):
    rows = spark.createDataFrame(
        [(1, dt.datetime(2025, 6, 1)), (2, dt.datetime(2025, 5, 31, 23, 59, 59)), (3, None)], "id int, created_at timestamp"
    )
    kept = reports.retained(rows, "created_at", 30, "2025-07-01 00:00:00")
    assert sorted(r.id for r in kept.collect()) == [1, 3]
