"""The run log: one row per run, replaced as the run moves on."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import contracts
from tallyhouse.sinks import files
from tallyhouse.sinks.outputs import OutputTarget


STARTED = "started"


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(microsecond=0)


@dataclass(frozen=True)
class Run:
    processing_date: dt.date
    pipeline_mode: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    start_time: dt.datetime = field(default_factory=utc_now)
    end_time: dt.datetime | None = None
    status: str = "RUNNING"
    records_processed: int | None = None
    records_valid: int | None = None
    records_invalid: int | None = None
    error_message: str | None = None

    def ended(self, status: str, error: str | None = None) -> Run:
        return replace(self, status=status, error_message=error, end_time=utc_now())

    @property
    def duration_seconds(self) -> int | None:
        return int((self.end_time - self.start_time).total_seconds()) if self.end_time else None


def record_run(spark: SparkSession, target: OutputTarget, run: Run) -> None:
    """Write the run's single row over the state it had before."""
    contract = contracts.RUN_LOG
    state = {
        **asdict(run),
        "processing_duration_seconds": run.duration_seconds,
        "created_at": run.start_time,
    }
    row = spark.range(1, numPartitions=1).select(*[F.lit(value).alias(name) for name, value in state.items()])
    folder = f"{target.path(contract)}/{STARTED}={run.start_time:%Y-%m-%d}"
    contract.enforce(row).write.mode("overwrite").parquet(f"{folder}/run={run.run_id}")


def read_run_log(spark: SparkSession, target: OutputTarget) -> DataFrame:
    contract = contracts.RUN_LOG
    return files.read_table(spark, target.path(contract), contract.schema, partition=STARTED)
