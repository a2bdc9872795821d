"""Hand-written transactions for unit tests."""

from __future__ import annotations

import datetime as dt

from tallyhouse.schema import TRANSACTION_FIELDS, TRANSACTION_SCHEMA

GOOD = {
    "transaction_id": "t1",
    "merchant_id": "m1",
    "card_number": "4111111111111234",
    "amount": 12.5,
    "timestamp": dt.datetime(2025, 6, 24, 0, 41, 5),
    "customer_id": "c1",
    "currency": "USD",
    "location": "Norfield",
}


def transactions(spark, *changes):
    """One row per change set, each applied to a good transaction."""
    rows = [tuple({**GOOD, **change}[f] for f in TRANSACTION_FIELDS) for change in changes]
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)


def many(spark, count, **columns):
    """``count`` good rows with their own ids; ``columns`` are SQL expressions over ``id``."""
    fields = {
        "transaction_id": "concat('t', id)",
        "merchant_id": "'m1'",
        "card_number": "'4111111111111234'",
        "amount": "CAST(12.5 AS DOUBLE)",
        "timestamp": "TIMESTAMP '2025-06-24 00:41:05'",
        "customer_id": "concat('c', id)",
        "currency": "'USD'",
        "location": "'Norfield'",
        **columns,
    }
    return spark.range(count).selectExpr(*[f"{text} AS {name}" for name, text in fields.items()])
