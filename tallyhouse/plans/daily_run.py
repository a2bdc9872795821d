"""The daily job: read, flag, mask, summarise, write.

Raw data is read and shuffled once. The flagged, masked transactions are written to the
shared scratch folder; every output and every count starts from that columnar copy, so
none of them parses the input or repeats the dedup. Cards are masked before that copy is
written, so no table holds a full number. The shuffle files of the dedup do, since the
choice of the row that stays compares it: encrypt them with ``spark.io.encryption.enabled``.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse import contracts
from tallyhouse.functions.money import MONEY
from tallyhouse.functions.rules import Rule
from tallyhouse.functions.scoring import DEFAULT_RISK, RiskPolicy
from tallyhouse.operators import masking, metrics
from tallyhouse.operators.validation import flag_transactions, validation_error_text
from tallyhouse.plans.incremental import SummaryStore
from tallyhouse.schema import IS_CORRUPT
from tallyhouse.session import require_ansi, require_utc, size_shuffles
from tallyhouse.sinks import files, outputs
from tallyhouse.sinks.jdbc import write_jdbc
from tallyhouse.sinks.landed_ids import LandedIds
from tallyhouse.sinks.outputs import OutputTarget
from tallyhouse.sinks.relational import write_relational
from tallyhouse.sinks.run_log import Run, record_run
from tallyhouse.sources import transactions

log = logging.getLogger(__name__)

COPIES = "copies"


@dataclass(frozen=True)
class RunResult:
    processing_date: str
    raw_count: int
    valid_count: int
    invalid_count: int
    data_quality_percentage: float
    summaries_generated: int

    @property
    def repeats_removed(self) -> int:
        return self.raw_count - self.valid_count - self.invalid_count


def hide_cards(flagged: DataFrame) -> DataFrame:
    """Replace the card number by its mask while valid and invalid rows are still together.

    The hashes wait until the processed table is written: they are long and do not
    compress, and no summary needs them.
    """
    return masking.mask_card_number(flagged).drop("card_number", IS_CORRUPT)


def processed_rows(valid: DataFrame, salt: str | None = None, separator: str = "") -> DataFrame:
    """Valid rows as stored. The transaction hash covers the amount in whole cents."""
    hashed = masking.transaction_hash(masking.hash_customer_id(valid, salt), separator)
    return hashed.drop("customer_id")


def run_counts(quality: DataFrame) -> dict[str, int]:
    """The figures of the run log, from the quality row of the day."""
    names = ("raw", "valid", "invalid")
    return quality.select(*[F.col(f"{n}_transactions").alias(n) for n in names]).first().asDict()


class DatabaseError(RuntimeError):
    """One or more tables that the database refused; the others were sent."""


def send_to_database(spark: SparkSession, target: OutputTarget, day: str, tables: Sequence[contracts.Contract]) -> None:
    """Append the day's committed partitions, so that nothing is computed again or differs.

    Every table is tried before the failures are raised together.
    """
    failures = []
    for contract in tables:
        stored = outputs.read_output(spark, target, contract).filter(F.col(files.DAY) == day).drop(files.DAY)
        try:
            shaped, table = outputs.database_shape(stored, contract), outputs.database_table(contract)
            if target.relational:
                write_relational(shaped, target.relational, table, contract.key)
            else:
                write_jdbc(shaped, target.jdbc, table)
        except Exception as error:
            log.warning("the database refused %s: %s", contract.table, type(error).__name__)
            failures.append((contract.table, error))
    if failures:
        described = "; ".join(f"{name}: {_described(error)}" for name, error in failures)
        raise DatabaseError(described) from failures[0][1]


def _described(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def process_transactions(
    raw: DataFrame,
    target: OutputTarget,
    processing_date: dt.date | str,
    pipeline_mode: str = "batch",
    rules: Sequence[Rule] | None = None,
    order_by: Sequence[str] | None = None,
    policy: RiskPolicy = DEFAULT_RISK,
    salt: str | None = None,
    separator: str = "",
    landed: LandedIds | None = None,
    summary_store: SummaryStore | None = None,
) -> RunResult:
    """Run the job on ``raw`` and store everything under partition ``processing_date``.

    Running the same date again replaces its outputs. Any failure raises after the run
    log was set to FAILED, or to PARTIAL if writing the outputs had already begun.
    With ``landed``, records whose id was stored as valid on an earlier date are left out
    and count as not read; the ids of this run's valid rows are recorded when it has ended.
    ``summary_store`` takes the run's valid rows in, so that its summaries hold late records too.
    """
    spark = raw.sparkSession
    require_utc(spark)
    require_ansi(spark)
    day = str(processing_date)
    run = Run(dt.date.fromisoformat(day), pipeline_mode)
    record_run(spark, target, run)
    status, scratch = "FAILED", []
    try:
        flagged = flag_transactions(raw, rules, order_by, copies_col=COPIES)
        seen = Observation()
        masked = hide_cards(flagged).observe(seen, *metrics.quality_measures(COPIES))
        staged, path = files.stage(masked, "flagged", ["is_valid"])
        scratch.append(path)

        size_shuffles(staged)
        counts = seen.get
        if landed:
            staged = landed.unseen(staged, day)
            counts = run_counts(metrics.data_quality_summary(staged, copies_col=COPIES))
        quality = metrics.quality_from_counts(spark, counts)
        run = replace(
            run,
            records_processed=counts["raw"],
            records_valid=counts["valid"],
            records_invalid=counts["invalid"],
        )

        created = F.lit(run.start_time)
        valid = staged.filter("is_valid").withColumns({"amount": F.col("amount").cast(MONEY), "created_at": created})
        invalid = staged.filter(~F.col("is_valid")).withColumn("created_at", created)
        rollup, path = files.stage(metrics.activity_rollup(valid, policy=policy), "rollup")
        scratch.append(path)
        reach = metrics.customer_reach(valid)
        by_day, path = files.stage(metrics.with_reach(metrics.merchant_day(rollup), reach), "merchant-day")
        scratch.append(path)

        summaries = metrics.comprehensive_summary(valid, rollup, by_day, policy=policy, generated_at=created)
        from_valid = {contracts.PROCESSED: processed_rows(valid, salt, separator)} | {
            contracts.SUMMARY_CONTRACTS[name]: frame for name, frame in summaries.items()
        }
        empty = set() if counts["valid"] else set(from_valid)
        if not counts["invalid"]:
            empty.add(contracts.INVALID)
        status = "PARTIAL"
        tables = outputs.write_tables({**from_valid, contracts.INVALID: invalid}, target, day, empty)
        seconds = run.ended("SUCCESS").duration_seconds
        errors = validation_error_text(staged).scalar()
        tables[contracts.QUALITY_REPORTS] = outputs.write_quality_report(
            quality, target, day, run.start_time, seconds, errors
        )

        if target.has_database:
            send_to_database(spark, target, day, list(tables))
        if summary_store:
            summary_store.update(valid, day)
        if landed:
            landed.record(valid, day)
        record_run(spark, target, run.ended("SUCCESS"))
    except Exception as error:
        record_run(spark, target, run.ended(status, _described(error)))
        raise
    finally:
        for path in scratch:
            files.drop_path(spark, path)

    share = counts["valid"] / counts["raw"] * 100 if counts["raw"] else 0.0
    return RunResult(day, counts["raw"], counts["valid"], counts["invalid"], share, len(summaries))


def process_day(
    spark: SparkSession,
    year: int | str,
    month: int | str,
    day: int | str,
    mode: str,
    raw_root: str,
    target: OutputTarget,
    multi_line: bool = True,
    **options,
) -> RunResult:
    """One day of JSON files through ``process_transactions``. A missing day is a FAILED run."""
    date = dt.date(int(year), int(month), int(day))
    run = Run(date, mode)
    try:
        raw = transactions.read_by_date(spark, raw_root, year, month, day, mode, multi_line)
    except Exception as error:
        record_run(spark, target, run.ended("FAILED", _described(error)))
        raise
    return process_transactions(raw, target, date, pipeline_mode=mode, **options)


def processing_report(result: RunResult) -> str:
    """The run in one line of figures; never any row contents."""
    read, kept, bad = result.raw_count, result.valid_count, result.invalid_count
    return (
        f"{result.processing_date}: read {read}, dropped {result.repeats_removed} repeats, stored {kept} valid "
        f"({result.data_quality_percentage:.2f} % of those read) and {bad} invalid rows, {result.summaries_generated} summary tables"
    )
