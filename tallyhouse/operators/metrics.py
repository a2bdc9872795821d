"""Merchant analytics over valid transactions.

A merchant-day can hold a third of all rows, so nothing is collected per merchant-day
straight from the transactions. ``activity_rollup`` first reduces them to one row per
merchant, date, currency and location, with the hours as bits of a number: a hash
aggregate over fixed-width buffers whose map-side half absorbs hot merchants and whose
shuffle key spreads the rest. Totals and sets per merchant-day are then folded, once,
from that far smaller frame. Customers have no such bound and are only ever counted, by
Spark's two-step distinct aggregate, which shuffles on (merchant, date, customer).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import money, scoring, text
from tallyhouse.functions.scoring import DEFAULT_RISK, RiskPolicy
from tallyhouse.schema import MERCHANT_DAY

ROLLUP_KEYS = [*MERCHANT_DAY, "currency", "location"]
HOURS = range(24)


def _cents_above(cents: Column, amount: float) -> Column:
    return F.count_if(cents > F.lit(round(amount * 100)))


def _money_measures(cents: Column) -> list[Column]:
    """Row count, amount count and amount total, under the names the projections use."""
    return [
        F.count("transaction_id").alias("transactions"),
        F.count(cents).alias("amounts"),
        F.sum(cents).alias("cents"),
    ]


def _with_cents(df: DataFrame) -> DataFrame:
    return df.withColumn("_cents", money.to_cents(F.col("amount")))


def activity_rollup(
    df: DataFrame, customer_col: str = "customer_id", policy: RiskPolicy = DEFAULT_RISK
) -> DataFrame:
    """One row per merchant, date, currency and location, with additive measures."""
    cents = F.col("_cents")
    high_part, low_part = money.square_parts(cents)
    return (
        _with_cents(df)
        .groupBy(*ROLLUP_KEYS)
        .agg(
            *_money_measures(cents),
            F.min(cents).alias("min_cents"),
            F.max(cents).alias("max_cents"),
            F.sum(high_part).alias("squares_high"),
            F.sum(low_part).alias("squares_low"),
            F.count(customer_col).alias("customers"),
            F.sum("completeness_score").alias("score_sum"),
            F.count("completeness_score").alias("scores"),
            F.min("timestamp").alias("first_time"),
            F.max("timestamp").alias("last_time"),
            F.bit_or(F.expr("shiftleft(1, transaction_hour)")).alias("hour_bits"),
            _cents_above(cents, policy.high_value).alias("high_value"),
            _cents_above(cents, policy.very_high_value).alias("very_high_value"),
        )
    )


def merchant_day(rollup: DataFrame, list_locations: bool = True) -> DataFrame:
    """Fold a rollup to one row per merchant and date: the input of A1, A2 and A7 alike.

    The stored summary lists the locations of a merchant-day; where only their number is
    wanted, say so and none is collected.
    """
    hours = F.filter(F.array(*map(F.lit, HOURS)), lambda h: F.getbit(F.coalesce(F.col("hour_bits"), F.lit(0)), h) == 1)
    listed = F.sort_array(F.collect_set("location")).alias("locations")
    locations = listed if list_locations else F.count_distinct("location").cast("int").alias("location_count")
    total = [
        "transactions", "amounts", "cents", "squares_high", "squares_low",
        "customers", "score_sum", "scores", "high_value", "very_high_value",
    ]
    day = rollup.groupBy(*MERCHANT_DAY).agg(
        *[F.sum(c).alias(c) for c in total],
        F.min("min_cents").alias("min_cents"),
        F.max("max_cents").alias("max_cents"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.sort_array(F.collect_set("currency")).alias("currencies"),
        F.bit_or("hour_bits").alias("hour_bits"),
        locations,
    )
    day = day.withColumn("hours", F.transform(hours, text.hour_label)).drop("hour_bits")
    return day.withColumn("location_count", F.size("locations")) if list_locations else day


def customer_reach(df: DataFrame, customer_col: str = "customer_id") -> DataFrame:
    """Exact distinct customers per merchant and date."""
    return df.groupBy(*MERCHANT_DAY).agg(F.count_distinct(customer_col).alias("unique_customers"))


def with_reach(day: DataFrame, reach: DataFrame) -> DataFrame:
    """``merchant_day`` rows with their ``unique_customers``; a NULL key finds its like."""
    other = reach.select(*[F.col(c).alias(f"_{c}") for c in MERCHANT_DAY], "unique_customers")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in MERCHANT_DAY]
    return day.join(other, same).drop(*[f"_{c}" for c in MERCHANT_DAY])


def summary_from_day(day: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """The daily merchant summary as a projection of ``merchant_day``."""
    now = F.current_timestamp() if generated_at is None else generated_at
    total, rows = F.col("cents"), F.col("amounts")
    deviation = money.sample_stddev(rows, total, F.col("squares_high"), F.col("squares_low"))
    return day.select(
        *MERCHANT_DAY,
        F.col("transactions").alias("total_transactions"),
        money.from_cents(total).alias("total_amount"),
        money.average(total, rows).alias("avg_transaction_amount"),
        money.from_cents(F.col("min_cents"), money.AVERAGE).alias("min_transaction_amount"),
        money.from_cents(F.col("max_cents"), money.AVERAGE).alias("max_transaction_amount"),
        deviation.alias("std_transaction_amount"),
        F.col("customers").alias("total_customers"),
        F.col("currencies").alias("currencies_used"),
        "locations",
        F.col("hours").alias("active_hours"),
        F.size("currencies").alias("currency_count"),
        "location_count",
        F.size("hours").alias("active_hour_count"),
        F.try_divide("score_sum", "scores").alias("avg_data_quality_score"),
        F.col("first_time").alias("first_transaction_time"),
        F.col("last_time").alias("last_transaction_time"),
        now.alias("summary_generated_at"),
    )


def _score(policy: RiskPolicy) -> Column:
    """Score over exact counts and cents.

    Double division of whole cents is correctly rounded, so exactly 0.8 is not above 0.8.
    """
    ratio = F.try_divide(F.col("max_cents").cast("double"), F.col("cents").cast("double"))
    return scoring.risk_score(
        F.col("very_high_value"), F.col("high_value"), F.col("transactions"), ratio, policy
    )


def _scored(frame: DataFrame, policy: RiskPolicy) -> DataFrame:
    biggest = F.col("max_cents")
    shown = money.half_up_ratio(biggest.cast("decimal(19,0)") * 10000, F.col("cents"))
    return frame.select(
        *MERCHANT_DAY,
        F.col("high_value").alias("high_value_transactions"),
        F.col("very_high_value").alias("very_high_value_transactions"),
        F.col("transactions").alias("transaction_velocity"),
        money.from_cents(biggest).alias("max_single_transaction"),
        money.from_ten_thousandths(shown).alias("max_transaction_ratio"),
        "unique_locations",
        "unique_customers",
        _score(policy).alias("risk_score"),
    ).withColumn("risk_level", scoring.risk_level(F.col("risk_score"), policy))


def risk_grades(day: DataFrame, policy: RiskPolicy = DEFAULT_RISK) -> DataFrame:
    """Score and level alone, which need no customer count."""
    scored = day.select(*MERCHANT_DAY, _score(policy).alias("risk_score"))
    return scored.withColumn("risk_level", scoring.risk_level(F.col("risk_score"), policy))


def risk_from_day(day: DataFrame, policy: RiskPolicy = DEFAULT_RISK) -> DataFrame:
    """Risk metrics as a projection of a merchant-day frame ``with_reach``."""
    return _scored(day.withColumn("unique_locations", F.col("location_count").cast("bigint")), policy)


def kpis_from_day(day: DataFrame) -> DataFrame:
    """Performance indicators as a projection of ``merchant_day``."""
    total = F.col("cents")
    return day.select(
        *MERCHANT_DAY,
        F.col("transactions").alias("transaction_count"),
        money.from_cents(total).alias("gross_volume"),
        money.average(total, F.col("amounts")).alias("average_ticket_size"),
        money.average(total, F.col("transactions")).alias("revenue_per_transaction"),
        F.col("customers").alias("customer_count"),
        money.average(total, F.col("customers")).alias("revenue_per_customer"),
        F.col("location_count").alias("active_locations"),
        F.size("hours").alias("operating_hours"),
        F.try_divide("score_sum", "scores").alias("data_quality_score"),
    )


def daily_merchant_summary(df: DataFrame, customer_col: str = "customer_id") -> DataFrame:
    return summary_from_day(merchant_day(activity_rollup(df, customer_col)))


def merchant_kpis(df: DataFrame, customer_col: str = "customer_id") -> DataFrame:
    return kpis_from_day(merchant_day(activity_rollup(df, customer_col), list_locations=False))


def risk_metrics(
    df: DataFrame, customer_col: str = "customer_id", policy: RiskPolicy = DEFAULT_RISK
) -> DataFrame:
    """Risk metrics in one pass over transactions that are not staged anywhere.

    Same result as ``risk_from_day``, which needs two frames. Rows are reduced per
    customer and location first, so that only those are copied for the two distinct counts.
    """
    cents = F.col("_cents")
    visits = (
        _with_cents(df)
        .groupBy(*MERCHANT_DAY, F.col(customer_col).alias("_customer"), "location")
        .agg(
            F.count("transaction_id").alias("transactions"),
            F.sum(cents).alias("cents"),
            F.max(cents).alias("max_cents"),
            _cents_above(cents, policy.high_value).alias("high_value"),
            _cents_above(cents, policy.very_high_value).alias("very_high_value"),
        )
    )
    counted = visits.groupBy(*MERCHANT_DAY).agg(
        *[F.sum(c).alias(c) for c in ("transactions", "cents", "high_value", "very_high_value")],
        F.max("max_cents").alias("max_cents"),
        F.count_distinct("location").alias("unique_locations"),
        F.count_distinct("_customer").alias("unique_customers"),
    )
    return _scored(counted, policy)


def _breakdown(measured: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return measured.select(
        *keys,
        F.col("transactions").alias(f"{prefix}_transactions"),
        money.from_cents(F.col("cents")).alias(f"{prefix}_amount"),
        money.average(F.col("cents"), F.col("amounts")).alias(f"{prefix}_avg_amount"),
    )


def _measured(df: DataFrame, keys: list[str]) -> DataFrame:
    return _with_cents(df).groupBy(*keys).agg(*_money_measures(F.col("_cents")))


def _refolded(rollup: DataFrame, keys: list[str]) -> DataFrame:
    return rollup.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("transactions", "amounts", "cents")])


HOURLY_KEYS = [*MERCHANT_DAY, "transaction_hour"]
CURRENCY_KEYS = [*MERCHANT_DAY, "currency"]


def hourly_patterns(df: DataFrame) -> DataFrame:
    return _breakdown(_measured(df, HOURLY_KEYS), HOURLY_KEYS, "hourly")


def hourly_partials(df: DataFrame) -> DataFrame:
    """Additive measures per merchant, date and hour; ``hourly_from_partials`` folds any number of them."""
    return _measured(df, HOURLY_KEYS)


def hourly_from_partials(partials: DataFrame) -> DataFrame:
    return _breakdown(_refolded(partials, HOURLY_KEYS), HOURLY_KEYS, "hourly")


def currency_breakdown(df: DataFrame) -> DataFrame:
    return _breakdown(_measured(df, CURRENCY_KEYS), CURRENCY_KEYS, "currency")


def currency_from_rollup(rollup: DataFrame) -> DataFrame:
    return _breakdown(_refolded(rollup, CURRENCY_KEYS), CURRENCY_KEYS, "currency")


def comprehensive_summary(
    valid: DataFrame,
    rollup: DataFrame | None = None,
    day: DataFrame | None = None,
    customer_col: str = "customer_id",
    policy: RiskPolicy = DEFAULT_RISK,
    generated_at: Column | None = None,
) -> dict[str, DataFrame]:
    """All summaries by name. Pass the stored ``rollup`` and ``day`` (``merchant_day`` with
    ``with_reach``) of these rows, so that one fold serves the three merchant-day tables."""
    if rollup is None:
        rollup = activity_rollup(valid, customer_col, policy)
    if day is None:
        day = with_reach(merchant_day(rollup), customer_reach(valid, customer_col))
    return {
        "daily_merchant_summary": summary_from_day(day, generated_at),
        "risk_metrics": risk_from_day(day, policy),
        "hourly_patterns": hourly_patterns(valid),
        "currency_breakdown": currency_from_rollup(rollup),
        "merchant_kpis": kpis_from_day(day),
    }


def data_quality_summary(flagged: DataFrame, by: list[str] | None = None, copies_col: str = "copies") -> DataFrame:
    """Counts and both quality percentages, overall or per ``by``.

    ``pct_of_raw`` divides by the rows read, repeats included; ``data_quality_percentage``
    by the rows left after dedup. The raw count comes from the copies each survivor
    stands for, so the input is not read again.
    """
    counted = flagged.groupBy(*(by or [])).agg(
        F.coalesce(F.sum(copies_col), F.lit(0)).alias("raw_transactions"),
        F.count_if("is_valid").alias("valid_transactions"),
        F.count_if(~F.col("is_valid")).alias("invalid_transactions"),
        F.count(F.lit(1)).alias("total_transactions"),
    )

    return with_percentages(counted)


QUALITY_COUNTS = ("raw", "valid", "invalid")


def quality_measures(copies_col: str = "copies") -> list[Column]:
    """The counts of ``data_quality_summary`` as measures to observe while flagged rows are written."""
    measures = F.coalesce(F.sum(copies_col), F.lit(0)), F.count_if("is_valid"), F.count_if(~F.col("is_valid"))
    return [measure.alias(name) for measure, name in zip(measures, QUALITY_COUNTS, strict=True)]


def quality_from_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The row of ``data_quality_summary`` from observed counts, without reading anything."""
    row = {f"{name}_transactions": counts[name] for name in QUALITY_COUNTS}
    row["total_transactions"] = counts["valid"] + counts["invalid"]
    return with_percentages(spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in row.items()]))


def with_percentages(counted: DataFrame) -> DataFrame:
    """Both quality percentages, of 0 rows as 0."""

    def percent(whole: str) -> Column:
        hundredths = money.half_up_ratio(F.col("valid_transactions") * 10000, F.col(whole))
        return money.from_cents(F.coalesce(hundredths, F.lit(0)), "decimal(5,2)")

    return counted.withColumns(
        {"pct_of_raw": percent("raw_transactions"), "data_quality_percentage": percent("total_transactions")}
    )
