"""Exact money arithmetic.

Sums of doubles depend on the order of the rows, hence on the partitioning. Money is
therefore aggregated as whole cents in bigint buffers, which hash aggregates update in
place, and turned into decimals only in the final projection. An overflow raises under
ANSI mode; it never yields a wrong total.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"
AVERAGE = "decimal(10,2)"

_SQUARE_SPLIT_BITS = 20


def to_cents(amount: Column) -> Column:
    return (amount.cast(MONEY) * F.lit(100)).cast("bigint")


def from_cents(cents: Column, as_type: str = MONEY) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(as_type)


def from_ten_thousandths(parts: Column) -> Column:
    return (parts.cast("decimal(20,0)") * F.lit(Decimal("0.0001"))).cast("decimal(5,4)")


def int_div(numerator: Column, denominator: Column) -> Column:
    return F.call_function("div", numerator, denominator)


def half_up_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` rounded half away from zero, in integers only.

    The denominator must not be negative; a zero one gives NULL.
    """
    safe = F.nullif(denominator, F.lit(0).cast("bigint"))
    size = int_div(F.abs(numerator) * 2 + safe, safe * 2)
    return F.when(numerator < 0, -size).otherwise(size)


def average(sum_cents: Column, rows: Column, as_type: str = AVERAGE) -> Column:
    return from_cents(half_up_ratio(sum_cents, rows), as_type)


def square_parts(cents: Column) -> tuple[Column, Column]:
    """High and low part of ``cents²``, each small enough to be summed as bigint.

    With cents = a·2²⁰ + b the square is (a²·2²⁰ + 2ab)·2²⁰ + b², whose parts stay within a
    bigint for amounts up to 30 billion, where the square itself would leave it above 30
    million. A larger amount raises.
    """
    low = cents.bitwiseAND(F.lit((1 << _SQUARE_SPLIT_BITS) - 1))
    high = F.shiftright(cents, _SQUARE_SPLIT_BITS)
    square = low * low
    return (
        high * high * F.lit(1 << _SQUARE_SPLIT_BITS) + high * low * 2 + F.shiftright(square, _SQUARE_SPLIT_BITS),
        square.bitwiseAND(F.lit((1 << _SQUARE_SPLIT_BITS) - 1)),
    )


def sample_stddev(rows: Column, sum_cents: Column, high: Column, low: Column) -> Column:
    """Sample deviation from exact sums: sqrt((n·Σx² − (Σx)²) / (n·(n−1))).

    The difference is taken between exact decimals, so nothing cancels away however
    large the group is. NULL for a single row.
    """
    wide = "decimal(38,0)"
    total = sum_cents.cast("decimal(19,0)")
    count = rows.cast("decimal(14,0)")
    squares = (high.cast("decimal(24,0)") * F.lit(1 << _SQUARE_SPLIT_BITS) + low).cast("decimal(24,0)")
    spread = (count * squares).cast(wide) - (total * total).cast(wide)
    pairs = (count * (count - 1)).cast("double")
    return F.when(rows > 1, F.sqrt(spread.cast("double") / F.nullif(pairs, F.lit(0.0))) / 100)
