from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import rules as R
from tallyhouse.operators import validation as V
from tallyhouse.operators.cleaning import clean_transactions
from tests.rows import transactions


def flags(spark, change):
    row = V.validate(clean_transactions(transactions(spark, change))).first()
    assert row.is_valid == (row.validation_errors == [])
    return row.validation_errors


@pytest.mark.parametrize(
    ("change", "errors"),
    [
        ({}, []),
        ({"transaction_id": None}, ["missing_transaction_id"]),
        ({"merchant_id": "   "}, ["missing_merchant_id"]),
        ({"timestamp": None}, ["missing_timestamp"]),
        ({"customer_id": ""}, ["missing_customer_id"]),
        ({"location": None}, ["missing_location"]),
        ({"amount": None}, ["missing_amount", "amount_out_of_range"]),
        ({"amount": 0.01}, []),
        ({"amount": 10000.0}, []),
        ({"amount": 0.009}, ["amount_out_of_range"]),
        ({"amount": 10000.004}, ["amount_out_of_range"]),
        ({"amount": float("nan")}, ["amount_out_of_range"]),
        ({"amount": -5.0}, ["amount_out_of_range"]),
        ({"card_number": "411"}, ["card_number_length"]),
        ({"card_number": None}, ["missing_card_number", "card_number_length"]),
        ({"card_number": "4111-1111-1111-1234"}, []),
        ({"card_number": "none"}, ["missing_card_number", "card_number_length"]),
        ({"currency": " jpy "}, []),
        ({"currency": "XXX"}, ["currency_not_allowed"]),
        ({"currency": None}, ["missing_currency", "currency_not_allowed"]),
        ({"amount": 0.0, "currency": "CHF"}, ["amount_out_of_range", "currency_not_allowed"]),
    ],
)
def test_rules(spark, change, errors):
    assert flags(spark, change) == errors


def test_valid_and_invalid_share_out_all_rows(spark):
    df = transactions(spark, {}, {"transaction_id": "t2", "amount": None}, {"transaction_id": None})
    flagged = V.flag_transactions(df, copies_col="copies")
    valid, invalid = V.valid_transactions(flagged), V.invalid_transactions(flagged)
    assert (valid.count(), invalid.count(), flagged.count()) == (1, 2, 3)
    assert dict(map(tuple, V.validation_counts(flagged).collect())) == {True: 1, False: 2}
    assert {r.validation_error: r.failures for r in V.validation_error_breakdown(flagged).collect()} == {
        "missing_amount": 1, "amount_out_of_range": 1, "missing_transaction_id": 1,
    }


def test_clean_and_validate_pair(spark):
    valid, invalid = V.clean_and_validate(transactions(spark, {}, {"transaction_id": "t2", "currency": "?"}))
    assert [r.transaction_id for r in valid.collect()] == ["t1"]
    assert [r.transaction_id for r in invalid.collect()] == ["t2"]
    assert "is_valid" not in valid.columns and "validation_errors" in invalid.columns


def test_money_is_rounded_only_after_the_range_check(spark):
    flagged = V.flag_transactions(transactions(spark, {"amount": 12.345}, {"transaction_id": "t2", "amount": 0.009}))
    assert str(V.valid_transactions(flagged).first().amount) == "12.35"
    assert V.invalid_transactions(flagged).first().amount == 0.009


@pytest.mark.parametrize(
    ("change", "score"),
    [
        ({}, 1.0),
        ({"amount": None}, 0.875),
        ({"amount": None, "timestamp": None}, 0.75),
        ({"customer_id": "  ", "location": None}, 0.75),
        ({"amount": float("nan")}, 1.0),
    ],
)
def test_completeness_counts_present_fields(spark, change, score):
    row = V.completeness_score(clean_transactions(transactions(spark, change))).first()
    assert row.completeness_score == score


def test_a_new_rule_is_one_more_list_entry(spark):
    df = clean_transactions(transactions(spark, {}, {"transaction_id": "t2", "location": "Nowhere"}))
    rules = [*R.standard_rules(df.schema), R.Rule("unknown_location", F.col("location") != "Nowhere")]
    errors = {r.transaction_id: r.validation_errors for r in V.validate(df, rules).collect()}
    assert errors == {"t1": [], "t2": ["unknown_location"]}


def test_a_rule_that_yields_null_fails(spark):
    df = clean_transactions(transactions(spark, {"location": None}))
    row = V.validate(df, [R.Rule("somewhere", F.col("location") != "Nowhere")]).first()
    assert row.validation_errors == ["somewhere"]


def test_no_rules_means_valid(spark):
    row = V.validate(clean_transactions(transactions(spark, {})), []).first()
    assert row.is_valid and row.validation_errors == []


def test_validation_stays_in_generated_code(spark):
    df = V.validate(clean_transactions(spark.createDataFrame([], transactions(spark, {}).schema)))
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
