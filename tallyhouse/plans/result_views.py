"""SQL over stored results: every table and report as a temporary view.

``spark.sql`` then runs from the text to the files in one Catalyst plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse import contracts
from tallyhouse.operators import reports
from tallyhouse.schema import MERCHANT_DAY
from tallyhouse.sinks import outputs
from tallyhouse.sinks.files import DAY
from tallyhouse.sinks.outputs import OutputTarget
from tallyhouse.sinks.run_log import read_run_log


def register_views(spark: SparkSession, target: OutputTarget) -> dict[str, DataFrame]:
    """Register the stored tables under their database names, and the three reports."""
    stored = [
        contracts.PROCESSED,
        contracts.INVALID,
        *contracts.SUMMARY_CONTRACTS.values(),
        contracts.QUALITY_REPORTS,
    ]
    views = {outputs.database_table(c): outputs.read_output(spark, target, c) for c in stored}
    views[contracts.RUN_LOG.table] = read_run_log(spark, target)
    summary = views[outputs.database_table(contracts.DAILY_MERCHANT_SUMMARY)]
    risk = views[outputs.database_table(contracts.RISK_METRICS)]
    views["daily_transaction_summary"] = reports.daily_transaction_summary(views[contracts.PROCESSED.table])
    views["merchant_performance_overview"] = reports.merchant_performance_overview(
        summary, risk, keys=[*MERCHANT_DAY, DAY]
    )
    views["data_quality_monitoring"] = reports.data_quality_monitoring(views[contracts.QUALITY_REPORTS.table])
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    # The parametrised report, for SQL text: SELECT * FROM get_merchant_summary('m', DATE'…', DATE'…').
    columns = reports.MERCHANT_SUMMARY_COLUMNS
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION get_merchant_summary(merchant STRING, first_day DATE, last_day DATE)
        RETURNS TABLE RETURN
        SELECT {", ".join(columns)} FROM {outputs.database_table(contracts.DAILY_MERCHANT_SUMMARY)}
        WHERE merchant_id = merchant AND transaction_date BETWEEN first_day AND last_day
        """
    )
    return views
