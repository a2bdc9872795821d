"""Clean-up of raw transactions. Everything here is row-local: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import text
from tallyhouse.schema import TEXT_FIELDS


def trim_strings(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text.trimmed(F.col(c)) for c in TEXT_FIELDS if c in df.columns})


def upper_currency(df: DataFrame) -> DataFrame:
    return df.withColumn("currency", text.upper_code(F.col("currency")))


def digits_only_card(df: DataFrame) -> DataFrame:
    return df.withColumn("card_number", text.digits_only(F.col("card_number")))


def cast_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", text.as_double(F.col("amount")))


def _timestamp(df: DataFrame) -> Column:
    return text.as_timestamp(F.col("timestamp"), df.schema["timestamp"].dataType)


def normalise_timestamp(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", _timestamp(df))


def derive_date_hour(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"transaction_date": F.to_date("timestamp"), "transaction_hour": F.hour("timestamp")}
    )


def clean_transactions(df: DataFrame) -> DataFrame:
    """All cleaning steps as one projection."""
    cleaned = {c: text.trimmed(F.col(c)) for c in TEXT_FIELDS if c in df.columns}
    cleaned["currency"] = text.upper_code(text.trimmed(F.col("currency")))
    cleaned["card_number"] = text.digits_only(text.trimmed(F.col("card_number")))
    cleaned["amount"] = text.as_double(F.col("amount"))
    moment = _timestamp(df)
    cleaned["timestamp"] = moment
    cleaned["transaction_date"] = F.to_date(moment)
    cleaned["transaction_hour"] = F.hour(moment)
    return df.withColumns(cleaned)
