"""Masking and hashing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The printed form of a masked card.
MASK_CHARACTER = "*"
CARD_DIGITS = 16
VISIBLE_DIGITS = 4


def card_mask(card: Column) -> Column:
    """Twelve stars and the last four digits; all stars if NULL or too short."""
    hidden = MASK_CHARACTER * (CARD_DIGITS - VISIBLE_DIGITS)
    return F.when(
        F.length(card) >= VISIBLE_DIGITS,
        F.concat(F.lit(hidden), F.right(card, F.lit(VISIBLE_DIGITS))),
    ).otherwise(F.lit(MASK_CHARACTER * CARD_DIGITS))


def customer_hash(customer: Column, salt: str | None = None) -> Column:
    """SHA-256 hex. Short ids can be guessed from it unless a salt is given."""
    return F.sha2(customer if salt is None else F.concat(F.lit(salt), customer), 256)


def audit_hash(
    transaction: Column,
    merchant: Column,
    amount: Column,
    timestamp: Column,
    separator: str = "",
) -> Column:
    """SHA-256 over id, merchant, amount and time; NULL if any part is NULL.

    The amount is printed as a double (``100.0``), whatever its stored type. Parts are
    joined without a separator by default; giving one keeps ('a', 'bc') and
    ('ab', 'c') apart.
    """
    parts = [transaction, merchant, amount.cast("double").cast("string"), timestamp.cast("string")]
    if separator:
        joined = parts[0]
        for part in parts[1:]:
            joined = F.concat(joined, F.lit(separator), part)
        return F.sha2(joined, 256)
    return F.sha2(F.concat(*parts), 256)
