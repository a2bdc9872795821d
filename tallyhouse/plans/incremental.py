"""Summaries that take late records in without reading the days' transactions again.

Each run leaves what its valid transactions add up to, per merchant-day and finer: the activity
rollup, the hours, and the distinct customers. Such partials merge by sums, extremes, bit-or and
union, whatever run they come from. After a run, the transaction dates it touched are folded anew
from the partials of all runs, and only those dates are replaced in the stored summaries. A late
record thus costs the partials of its own date. Everything is exact: counts of distinct customers
come from the customers themselves.

A run that is repeated replaces its partials, and the dates of its former attempt are folded
again as well, so that nothing of it stays behind.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.contracts import SUMMARY_CONTRACTS
from tallyhouse.functions.scoring import DEFAULT_RISK, RiskPolicy
from tallyhouse.operators import metrics
from tallyhouse.schema import MERCHANT_DAY
from tallyhouse.session import sized_shuffles
from tallyhouse.sinks import files

RUN = "run"
DATE = "transaction_date"
PARTIALS = ("rollup", "hours", "customers")
_LEAST = ("min_cents", "first_time")
_GREATEST = ("max_cents", "last_time")


def _merged_rollup(partials: DataFrame) -> DataFrame:
    """One row per merchant, date, currency and location, from those of several runs."""
    measures = [c for c in partials.columns if c not in (*metrics.ROLLUP_KEYS, RUN)]

    def merge(name):
        if name == "hour_bits":
            return F.bit_or(name)
        return F.min(name) if name in _LEAST else F.max(name) if name in _GREATEST else F.sum(name)

    kinds = dict(partials.dtypes)
    # Sums widen decimals; the fold works on the types of a single rollup.
    return partials.groupBy(*metrics.ROLLUP_KEYS).agg(*[merge(c).cast(kinds[c]).alias(c) for c in measures])


@dataclass(frozen=True)
class SummaryStore:
    """Partials of all runs and the summaries made of them, below ``root``."""

    root: str
    policy: RiskPolicy = DEFAULT_RISK

    def _partials(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/partials/{name}"

    def _summary(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/summaries/{name}"

    def _write_partials(self, valid: DataFrame, run: str) -> None:
        made = {
            "rollup": metrics.activity_rollup(valid, policy=self.policy),
            "hours": metrics.hourly_partials(valid),
            "customers": valid.select(*MERCHANT_DAY, "customer_id").distinct(),
        }
        for name, frame in made.items():
            with sized_shuffles(frame):
                frame.write.mode("overwrite").partitionBy(DATE).parquet(f"{self._partials(name)}/{RUN}={run}")

    def dates(self, spark: SparkSession, run: str) -> set[dt.date | None]:
        """The transaction dates a run has partials of; one for each folder."""
        path = f"{self._partials('rollup')}/{RUN}={run}"
        try:
            stored = spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return set()
            raise
        return {r[0] for r in stored.select(F.col(DATE).cast("date")).distinct().collect()} if DATE in stored.columns else set()

    def _read(self, spark: SparkSession, name: str, touched: list[dt.date]) -> DataFrame:
        """The partials of ``touched`` dates, of all runs; other dates' folders are not read."""
        partials = spark.read.parquet(self._partials(name))
        return partials.withColumn(DATE, F.col(DATE).cast("date")).where(F.col(DATE).isin(touched))

    def update(self, valid: DataFrame, run: dt.date | str) -> list[dt.date]:
        """Take the valid transactions of a run in; returns the dates whose summaries were made again.

        Rows without a date are in no summary of a day; validation has set them apart before.
        """
        spark, run = valid.sparkSession, str(run)
        before = self.dates(spark, run)
        self._write_partials(valid.where(F.col(DATE).isNotNull()), run)
        touched = sorted(before | self.dates(spark, run))
        if not touched:
            return []
        left = {r[0] for r in self._read(spark, "rollup", touched).select(DATE).distinct().collect()}
        for name, frame in self.fold(spark, touched).items():
            self._replace(frame.drop("summary_generated_at"), name)
            for date in set(touched) - left:
                files.drop_path(spark, f"{self._summary(name)}/_date={date}")
        return touched

    def fold(self, spark: SparkSession, touched: list[dt.date]) -> dict[str, DataFrame]:
        """The summaries of ``touched`` dates, from the partials of all runs."""
        rollup, _ = files.stage(_merged_rollup(self._read(spark, "rollup", touched)), "merged-rollup")
        customers = self._read(spark, "customers", touched).select(*MERCHANT_DAY, "customer_id").distinct()
        day = metrics.with_reach(metrics.merchant_day(rollup), metrics.customer_reach(customers))
        day, _ = files.stage(day, "merged-days")
        hours = self._read(spark, "hours", touched)
        return {
            "daily_merchant_summary": metrics.summary_from_day(day),
            "risk_metrics": metrics.risk_from_day(day, self.policy),
            "hourly_patterns": metrics.hourly_from_partials(hours),
            "currency_breakdown": metrics.currency_from_rollup(rollup),
            "merchant_kpis": metrics.kpis_from_day(day),
        }

    def _replace(self, frame: DataFrame, name: str) -> None:
        """Swap in the dates of ``frame`` when the job commits; other dates stay."""
        frame = frame.withColumn("_date", F.col(DATE))
        writer = frame.hint("rebalance", "_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        with sized_shuffles(frame):
            writer.partitionBy("_date").parquet(self._summary(name))

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """A stored summary by name, as its contract has it, without the time it was made at."""
        columns = [c for c in SUMMARY_CONTRACTS[name].columns if c != "summary_generated_at"]
        return spark.read.parquet(self._summary(name)).select(*columns)
