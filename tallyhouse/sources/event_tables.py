"""Transactions derived from the ``events`` and ``nation`` Parquet tables.

The test data has no transactions, so each event becomes one: with repeats, padding,
short and dashed cards, missing and out-of-range amounts, blank customers and bad
currencies at fixed rates. The whole table is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEDUP_ORDER = ["ingest_seq"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def transactions_from_events(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Raw transactions; ``ingest_seq`` is the arrival order, ``landing_date`` the folder date."""
    seq = F.col("event_id")
    value = F.col("value").cast("decimal(10,2)")
    velocity_merchant = (seq % 9).isin(1, 2, 4, 5)

    transaction_id = F.concat(F.lit("txn"), F.when(seq % 50 == 49, seq - 1).otherwise(seq).cast("string"))
    merchant = (
        F.when(seq % 97 == 0, F.concat(F.lit("merch_s"), (seq % 997).cast("string")))
        .when(seq % 3 == 0, F.lit("merch_000"))
        .when(velocity_merchant, F.lit("merch_001"))
        .otherwise(F.concat(F.lit("merch_"), F.lpad((F.col("user_id") % 20).cast("string"), 3, "0")))
    )
    last_four = F.lpad((seq % 10000).cast("string"), 4, "0")
    card = (
        F.when(seq % 25 == 1, F.lit("411111"))
        .when(seq % 25 == 2, F.lit(None).cast("string"))
        .when(seq % 25 == 3, F.concat(F.lit("4111-1111-1111-"), last_four))
        .otherwise(F.concat(F.lit("411111111111"), last_four))
    )
    amount = (
        F.when(seq % 40 == 7, F.lit(None).cast("decimal(15,2)"))
        .when(seq % 40 == 8, (-value).cast("decimal(15,2)"))
        .when((seq % 5 == 0) & ~velocity_merchant, (value * 50).cast("decimal(15,2)"))
        .otherwise((value * 5).cast("decimal(15,2)"))
    )
    moment = F.date_trunc("second", "ts").cast("timestamp_ntz")
    customer = F.when(seq % 71 == 4, F.lit("   ")).otherwise(F.concat(F.lit("cust_"), F.col("user_id").cast("string")))
    currency = (
        F.when(seq % 33 == 5, F.lit("XXX"))
        .when(F.col("event_type") == "signup", F.lit("usd"))
        .when(F.col("event_type") == "purchase", F.lit(" EUR "))
        .when(F.col("event_type") == "view", F.lit("GBP"))
        .when(F.col("event_type") == "click", F.lit("JPY"))
        .otherwise(F.lit("CAD"))
    )
    return events.join(nation, F.col("n_nationkey") == F.col("user_id") % 25).select(
        transaction_id.alias("transaction_id"),
        F.concat(F.lit(" "), merchant, F.lit(" ")).alias("merchant_id"),
        card.alias("card_number"),
        amount.alias("amount"),
        F.when(seq % 61 == 5, F.lit(None).cast("timestamp_ntz")).otherwise(moment).alias("timestamp"),
        customer.alias("customer_id"),
        currency.alias("currency"),
        F.col("n_name").alias("location"),
        seq.alias("ingest_seq"),
        F.col("ts").cast("date").alias("landing_date"),
    )


def read_event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return transactions_from_events(table(spark, folder, "events"), table(spark, folder, "nation"))
