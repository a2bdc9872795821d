from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyhouse.operators import cleaning
from tests.rows import transactions


def test_all_steps_in_one_projection(spark):
    raw = transactions(
        spark,
        {
            "transaction_id": " t1 ",
            "merchant_id": "m1  ",
            "card_number": " 4111-1111 1111-1234 ",
            "currency": " usd ",
            "location": "  Norfield",
        },
    )
    row = cleaning.clean_transactions(raw).first()
    assert (row.transaction_id, row.merchant_id, row.location) == ("t1", "m1", "Norfield")
    assert row.card_number == "4111111111111234"
    assert row.currency == "USD"
    assert row.transaction_date == dt.date(2025, 6, 24)
    assert row.transaction_hour == 0


def test_only_spaces_are_trimmed(spark):
    row = cleaning.clean_transactions(transactions(spark, {"location": "\tA "})).first()
    assert row.location == "\tA"


def test_steps_compose_to_the_whole(spark):
    raw = transactions(spark, {"currency": " eur", "card_number": "4111-1111-1111-1234"}, {"location": None})
    steps = raw
    for step in (
        cleaning.trim_strings, cleaning.upper_currency, cleaning.digits_only_card,
        cleaning.cast_amount, cleaning.normalise_timestamp, cleaning.derive_date_hour,
    ):
        steps = steps.transform(step)
    assert steps.collect() == cleaning.clean_transactions(raw).collect()


def test_text_that_is_no_number_or_time_becomes_null(spark):
    raw = transactions(spark, {}).withColumns(
        {"amount": F.lit("twelve"), "timestamp": F.lit("yesterday")}
    )
    row = cleaning.clean_transactions(raw).first()
    assert row.amount is None and row.timestamp is None and row.transaction_date is None


def test_text_time_is_parsed_with_its_literal_suffix(spark):
    raw = transactions(spark, {}).withColumn("timestamp", F.lit("2025-06-24T23:05:00Z"))
    row = cleaning.clean_transactions(raw).select(F.col("timestamp").cast("string").alias("t"), "transaction_hour").first()
    assert tuple(row) == ("2025-06-24 23:05:00", 23)


def test_cleaning_needs_no_shuffle(spark):
    plan = cleaning.clean_transactions(transactions(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
