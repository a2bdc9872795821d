"""Risk, volume and quality gradings. Every cascade takes its first match."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RiskPolicy:
    """Thresholds and scores of the risk cascade, in test order."""

    high_value: float = 1000
    very_high_value: float = 5000
    very_high_count: int = 5
    very_high_score: int = 10
    high_count: int = 10
    high_score: int = 8
    velocity: int = 100
    velocity_score: int = 6
    concentration: float = 0.8
    concentration_score: int = 7
    base_score: int = 3
    high_level: int = 8
    medium_level: int = 6


DEFAULT_RISK = RiskPolicy()


def risk_score(
    very_high: Column, high: Column, velocity: Column, ratio: Column, policy: RiskPolicy = DEFAULT_RISK
) -> Column:
    return (
        F.when(very_high > policy.very_high_count, F.lit(policy.very_high_score))
        .when(high > policy.high_count, F.lit(policy.high_score))
        .when(velocity > policy.velocity, F.lit(policy.velocity_score))
        .when(ratio > policy.concentration, F.lit(policy.concentration_score))
        .otherwise(F.lit(policy.base_score))
    )


def risk_level(score: Column, policy: RiskPolicy = DEFAULT_RISK) -> Column:
    return (
        F.when(score >= policy.high_level, F.lit("HIGH"))
        .when(score >= policy.medium_level, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


@dataclass(frozen=True)
class VolumePolicy:
    """Above how many transactions and how much money a day counts as what."""

    high: tuple[int, int] = (100, 10_000)
    medium: tuple[int, int] = (50, 5_000)


def volume_category(transactions: Column, amount: Column, policy: VolumePolicy = VolumePolicy()) -> Column:
    above = lambda limits: (transactions > limits[0]) & (amount > limits[1])
    graded = F.when(above(policy.high), F.lit("HIGH_VOLUME")).when(above(policy.medium), F.lit("MEDIUM_VOLUME"))
    return graded.otherwise(F.lit("LOW_VOLUME"))


# The least percentage of valid rows for each status.
QUALITY_STATUSES = {"EXCELLENT": 95, "GOOD": 90, "ACCEPTABLE": 85}


def quality_status(percentage: Column) -> Column:
    graded = F.lit("NEEDS_ATTENTION")
    for status, least in reversed(QUALITY_STATUSES.items()):
        graded = F.when(percentage >= least, F.lit(status)).otherwise(graded)
    return graded
