from __future__ import annotations

import statistics
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.functions import money


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 1_000_000), min_size=1, max_size=40))
def test_average_and_deviation_are_exact(spark, cents):
    df = spark.createDataFrame([(c,) for c in cents], "c bigint")
    high, low = money.square_parts(F.col("c"))
    row = (
        df.agg(F.count("c").alias("n"), F.sum("c").alias("s"), F.sum(high).alias("h"), F.sum(low).alias("l"))
        .select(
            money.average(F.col("s"), F.col("n"), money.MONEY),
            money.sample_stddev(F.col("n"), F.col("s"), F.col("h"), F.col("l")),
        )
        .first()
    )
    mean = Decimal(sum(cents)) / Decimal(len(cents)) / 100
    assert row[0] == mean.quantize(Decimal("0.01"), ROUND_HALF_UP)
    if len(cents) == 1:
        assert row[1] is None
    else:
        assert row[1] == pytest.approx(statistics.stdev(cents) / 100, rel=1e-12, abs=1e-12)


def test_deviation_of_equal_large_amounts_is_zero(spark):
    """The textbook formula in doubles loses all digits here."""
    n, cents = 3_000_000_000, 999_999
    square = cents * cents
    values = [n, n * cents, n * (square >> 20), n * (square & (2**20 - 1))]
    columns = [F.lit(v).cast("bigint") for v in values]
    assert one(spark, money.sample_stddev(*columns)) == 0.0


@pytest.mark.parametrize(("num", "den", "out"), [(5, 10, 1), (4, 10, 0), (-5, 10, -1), (-4, 10, 0), (7, 2, 4), (1, 0, None)])
def test_half_up_ratio(spark, num, den, out):
    assert one(spark, money.half_up_ratio(F.lit(num).cast("bigint"), F.lit(den).cast("bigint"))) == out


def test_cents_round_half_up(spark):
    assert one(spark, money.to_cents(F.lit(10.005))) == 1001
    assert one(spark, money.from_cents(F.lit(1001).cast("bigint"))) == Decimal("10.01")


def test_overflow_raises(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CANNOT_CHANGE_DECIMAL|overflow"):
        one(spark, money.from_cents(F.lit(10**16).cast("bigint"), money.AVERAGE))


def test_deviation_of_amounts_above_thirty_million(spark):
    cents = [5_000_000_000, 6_000_000_000, 100]
    df = spark.createDataFrame([(c,) for c in cents], "c bigint")
    high, low = money.square_parts(F.col("c"))
    sums = df.agg(F.count("c").alias("n"), F.sum("c").alias("s"), F.sum(high).alias("h"), F.sum(low).alias("l"))
    found = sums.select(money.sample_stddev(F.col("n"), F.col("s"), F.col("h"), F.col("l"))).first()[0]
    assert found == pytest.approx(statistics.stdev(cents) / 100, rel=1e-12)
