"""The stored tables of a run: where each goes and how it is written."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import contracts
from tallyhouse.contracts import Contract
from tallyhouse.sinks import files, jdbc
from tallyhouse.sinks.relational import RelationalTarget


PARALLEL_WRITES = 4


@dataclass(frozen=True)
class OutputTarget:
    """A root folder at any URI, a file format, and optionally a relational copy.

    ``relational`` commits a table at once and can be written again; ``jdbc`` appends task by task.
    """

    root: str
    fmt: str = "parquet"
    jdbc: jdbc.JdbcTarget | None = None
    relational: RelationalTarget | None = None

    @property
    def has_database(self) -> bool:
        return bool(self.jdbc or self.relational)

    def path(self, contract: Contract) -> str:
        return f"{self.root.rstrip('/')}/{_FOLDERS[contract.table]}"


# Folder of each table below the root, and its name in a database.
_FOLDERS = {
    "processed_transactions": "processed/transactions",
    "invalid_transactions": "processed/invalid_transactions",
    "daily_merchant_summary": "summaries/daily_merchant_summary",
    "risk_metrics": "summaries/risk_metrics",
    "hourly_patterns": "summaries/hourly_patterns",
    "currency_breakdown": "summaries/currency_breakdown",
    "merchant_kpis": "summaries/merchant_kpis",
    "data_quality_reports": "summaries/data_quality_reports",
    "pipeline_processing_logs": "logs/pipeline_processing_logs",
}


def database_table(contract: Contract) -> str:
    return f"summary_{contract.table}" if contract.table in contracts.SUMMARY_CONTRACTS else contract.table


def database_shape(frame: DataFrame, contract: Contract) -> DataFrame:
    """The columns the relational table has; the masked card goes into its card column."""
    if contract is contracts.PROCESSED:
        return frame.drop("card_number_masked")
    if contract is contracts.INVALID:
        return frame.withColumnRenamed("card_number_masked", "card_number")
    if contract is contracts.QUALITY_REPORTS:
        return frame.drop("raw_transactions", "pct_of_raw")
    return frame


def read_output(spark: SparkSession, target: OutputTarget, contract: Contract) -> DataFrame:
    return files.read_table(spark, target.path(contract), contract.schema, target.fmt)


def write_table(
    df: DataFrame, contract: Contract, target: OutputTarget, day: str, empty: bool | None = None
) -> DataFrame:
    """Replace the day's partition by ``df``, held to the contract; returns the frame written."""
    frame = contract.enforce(df, lengths=target.has_database)
    files.replace_day(frame, target.path(contract), day, target.fmt, empty, contract.cluster_by, contract.find_by)
    return frame


def write_tables(
    tables: dict[Contract, DataFrame],
    target: OutputTarget,
    day: str,
    empty: Collection[Contract] | None = None,
) -> dict[Contract, DataFrame]:
    """Write independent tables side by side, so that the small ones do not queue.

    ``empty`` names the tables that have no rows, if that is known. All writes are waited
    for; the first error is raised.
    """

    @inheritable_thread_target(next(iter(tables.values())).sparkSession)
    def write(contract: Contract) -> DataFrame:
        no_rows = None if empty is None else contract in empty
        return write_table(tables[contract], contract, target, day, no_rows)

    with ThreadPoolExecutor(max_workers=PARALLEL_WRITES) as pool:
        pending = {contract: pool.submit(write, contract) for contract in tables}
    return {contract: written.result() for contract, written in pending.items()}


def write_processed(masked: DataFrame, target: OutputTarget, day: str) -> DataFrame:
    return write_table(masked, contracts.PROCESSED, target, day)


def write_invalid(invalid: DataFrame, target: OutputTarget, day: str) -> DataFrame:
    """The day's invalid transactions; the contract takes a masked card only."""
    return write_table(invalid, contracts.INVALID, target, day)


def write_summaries(summaries: dict[str, DataFrame], target: OutputTarget, day: str) -> dict[Contract, DataFrame]:
    """Summaries by name, as ``comprehensive_summary`` returns them."""
    return write_tables({contracts.SUMMARY_CONTRACTS[n]: frame for n, frame in summaries.items()}, target, day)


def write_quality_report(
    quality: DataFrame,
    target: OutputTarget,
    day: str,
    created_at: dt.datetime,
    duration_seconds: int | None,
    errors: Column | str | None = None,
) -> DataFrame:
    """One row for the day, from an aggregate over the flagged transactions."""
    report = quality.withColumns(
        {
            "processing_date": F.lit(day),
            "processing_duration_seconds": F.lit(duration_seconds),
            "errors_encountered": errors if isinstance(errors, Column) else F.lit(errors),
            "created_at": F.lit(created_at),
        }
    )
    return write_table(report, contracts.QUALITY_REPORTS, target, day, empty=False)
