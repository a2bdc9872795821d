"""Validation: one flagged frame instead of two filtered scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import rules as R
from tallyhouse.functions.money import MONEY
from tallyhouse.operators.cleaning import clean_transactions
from tallyhouse.operators.dedup import dedup_transactions
from tallyhouse.schema import IS_CORRUPT

FLAG_COLUMNS = ["is_valid", "validation_errors"]


def validate(df: DataFrame, rules: Sequence[R.Rule] | None = None) -> DataFrame:
    """Add ``is_valid`` and ``validation_errors``; no row is dropped.

    Valid means that no rule failed, so the two columns always agree.
    """
    if rules is None:
        rules = R.standard_rules(df.schema)
    return df.withColumns({"is_valid": R.all_passed(rules), "validation_errors": R.failed_names(rules)})


def completeness_score(df: DataFrame) -> DataFrame:
    return df.withColumn("completeness_score", R.completeness(df.schema))


def valid_transactions(flagged: DataFrame) -> DataFrame:
    """Valid rows; the amount becomes exact money only now, after its range was checked."""
    return (
        flagged.filter("is_valid")
        .withColumn("amount", F.col("amount").cast(MONEY))
        .drop(*FLAG_COLUMNS, IS_CORRUPT)
    )


def invalid_transactions(flagged: DataFrame) -> DataFrame:
    """Invalid rows with the reasons and the amount as it was sent."""
    return flagged.filter(~F.col("is_valid")).drop("is_valid", IS_CORRUPT)


def validation_counts(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("is_valid").agg(F.count(F.lit(1)).alias("transactions"))


def validation_error_breakdown(flagged: DataFrame) -> DataFrame:
    """Failures per rule; a row that fails two rules counts in both."""
    return (
        flagged.filter(~F.col("is_valid"))
        .select(F.explode("validation_errors").alias("validation_error"))
        .groupBy("validation_error")
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def validation_error_text(flagged: DataFrame) -> DataFrame:
    """The breakdown as one JSON object, one entry per rule that failed; NULL if none did."""
    entries = F.sort_array(F.collect_list(F.struct("validation_error", "failures")))
    text = F.to_json(F.map_from_entries(entries))
    return validation_error_breakdown(flagged).agg(
        F.when(F.count(F.lit(1)) > 0, text).alias("errors_encountered")
    )


def flag_transactions(
    raw: DataFrame,
    rules: Sequence[R.Rule] | None = None,
    order_by: Sequence[str] | None = None,
    copies_col: str | None = None,
) -> DataFrame:
    """clean → dedup → validate → score, with valid and invalid rows in one frame."""
    deduped = clean_transactions(raw).transform(
        dedup_transactions, order_by=order_by, copies_col=copies_col
    )
    return completeness_score(validate(deduped, rules))


def clean_and_validate(
    raw: DataFrame,
    rules: Sequence[R.Rule] | None = None,
    order_by: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The (valid, invalid) pair. Both share one lineage: stage it if you write both."""
    flagged = flag_transactions(raw, rules, order_by)
    return valid_transactions(flagged), invalid_transactions(flagged)
