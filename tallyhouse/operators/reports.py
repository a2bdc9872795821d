"""Reports over stored results."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import money, scoring
from tallyhouse.schema import MERCHANT_DAY


def daily_transaction_summary(processed: DataFrame) -> DataFrame:
    """Totals per day over all merchants.

    A day is a single group, so rows are first reduced to (date, merchant, location,
    currency); the three distinct counts then run over that.
    """
    cents = money.to_cents(F.col("amount"))
    reduced = processed.groupBy("transaction_date", "merchant_id", "location", "currency").agg(
        F.count(F.lit(1)).alias("rows"), F.count(cents).alias("amounts"), F.sum(cents).alias("cents")
    )
    return (
        reduced.groupBy("transaction_date")
        .agg(
            F.sum("rows").alias("total_transactions"),
            F.sum("amounts").alias("_amounts"),
            F.sum("cents").alias("_cents"),
            F.count_distinct("merchant_id").alias("active_merchants"),
            F.count_distinct("location").alias("active_locations"),
            F.count_distinct("currency").alias("currencies_used"),
        )
        .select(
            "transaction_date",
            "total_transactions",
            money.from_cents(F.col("_cents"), "decimal(21,2)").alias("total_volume"),
            money.average(F.col("_cents"), F.col("_amounts"), money.MONEY).alias("avg_transaction_size"),
            "active_merchants",
            "active_locations",
            "currencies_used",
        )
        .orderBy(F.desc("transaction_date"))
    )


def merchant_performance_overview(
    summary: DataFrame, risk: DataFrame, keys: Sequence[str] = MERCHANT_DAY
) -> DataFrame:
    """Every merchant-day of the summary with its risk, if there is one.

    Name more ``keys`` if the frames hold several rows per merchant-day, as stored
    tables do when a late record is processed on another date.
    """
    keys = list(keys)
    return (
        summary.join(risk.select(*keys, "risk_level", "risk_score"), keys, "left")
        .select(
            *MERCHANT_DAY,
            "total_transactions",
            "total_amount",
            "avg_transaction_amount",
            "risk_level",
            "risk_score",
            scoring.volume_category(F.col("total_transactions"), F.col("total_amount")).alias("volume_category"),
        )
        .orderBy(F.desc("transaction_date"), F.desc("total_amount"))
    )


def data_quality_monitoring(reports: DataFrame) -> DataFrame:
    return reports.select(
        "processing_date",
        "total_transactions",
        "valid_transactions",
        "invalid_transactions",
        "data_quality_percentage",
        scoring.quality_status(F.col("data_quality_percentage")).alias("quality_status"),
    ).orderBy(F.desc("processing_date"))


# What the report of one merchant shows.
MERCHANT_SUMMARY_COLUMNS = (
    *MERCHANT_DAY,
    "total_transactions",
    "total_amount",
    "avg_transaction_amount",
    "total_customers",
    "currency_count",
    "location_count",
)


def get_merchant_summary(
    summary: DataFrame, merchant_id: str, start: dt.date | str, end: dt.date | str
) -> DataFrame:
    """One merchant's days from ``start`` to ``end``, both included."""
    first, last = (F.lit(str(d)).cast("date") for d in (start, end))
    return (
        summary.filter((F.col("merchant_id") == merchant_id) & F.col("transaction_date").between(first, last))
        .select(*MERCHANT_SUMMARY_COLUMNS)
        .orderBy("transaction_date")
    )


def expired(created_col: str, retention_days: int, now: dt.datetime | str) -> Column:
    """True for rows older than the retention. A row without a creation time never expires."""
    cutoff = F.lit(str(now)).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(retention_days))
    return F.coalesce(F.col(created_col).cast("timestamp_ntz") < cutoff, F.lit(False))


def retained(df: DataFrame, created_col: str, retention_days: int, now: dt.datetime | str) -> DataFrame:
    return df.filter(~expired(created_col, retention_days, now))
