"""Retention: drop old audit rows, keep processed transactions and summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tallyhouse import contracts
from tallyhouse.operators.reports import expired, retained
from tallyhouse.sinks import files, outputs
from tallyhouse.sinks.outputs import OutputTarget
from tallyhouse.sinks.run_log import STARTED, read_run_log, utc_now


def _utc_text(now: dt.datetime) -> str:
    if now.tzinfo is not None:
        now = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return str(now)


def cleanup_old_data(
    spark: SparkSession, target: OutputTarget, retention_days: int, now: dt.datetime | None = None
) -> dict[str, int]:
    """Delete invalid transactions and run-log rows created more than ``retention_days`` ago.

    Returns the rows deleted per table. One count per partition finds the partitions that
    hold expired rows; the driver sees a line for each of those days. Days with nothing
    left are dropped as folders, the others are rewritten together in one job.
    """
    moment = _utc_text(now or utc_now())
    contract, path = contracts.INVALID, target.path(contracts.INVALID)
    invalid = outputs.read_output(spark, target, contract)
    old = expired("created_at", retention_days, moment)
    days = (
        invalid.groupBy(files.DAY)
        .agg(F.count_if(old).alias("expired"), F.count(F.lit(1)).alias("rows"))
        .filter("expired > 0")
        .collect()
    )
    partly = [d[files.DAY] for d in days if d["expired"] < d["rows"]]
    if partly:
        # Staged first: the partitions being replaced are also the ones being read.
        kept = retained(invalid.filter(F.col(files.DAY).isin(partly)), "created_at", retention_days, moment)
        survivors, scratch = files.stage(kept, "retained")
        files.replace_days(survivors, path, target.fmt)
        files.drop_path(spark, scratch)
    for day in days:
        if day["expired"] == day["rows"]:
            files.drop_path(spark, f"{path}/{files.DAY}={day[files.DAY]}")

    dropped = _drop_expired_runs(spark, target, old)
    return {contract.table: sum(d["expired"] for d in days), contracts.RUN_LOG.table: dropped}


def _drop_expired_runs(spark: SparkSession, target: OutputTarget, old: Column) -> int:
    """Drop the run log's expired days as folders; only the day the limit falls in is looked into."""
    log_path = target.path(contracts.RUN_LOG)
    days = read_run_log(spark, target).groupBy(STARTED).agg(F.count_if(old).alias("expired"), F.count(F.lit(1)).alias("rows"))
    days = days.filter("expired > 0").collect()
    for day in days:
        folder = f"{log_path}/{STARTED}={day[STARTED]}"
        if day["expired"] == day["rows"]:
            files.drop_path(spark, folder)
            continue
        runs = read_run_log(spark, target).filter((F.col(STARTED) == F.lit(day[STARTED])) & old).select("run_id").collect()
        for run in runs:
            files.drop_path(spark, f"{folder}/run={run['run_id']}")
    return sum(day["expired"] for day in days)
