"""The registered queries: every operator over the whole derived transaction table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse import contracts
from tallyhouse.contracts import SUMMARY_CONTRACTS
from tallyhouse.functions import rules as R
from tallyhouse.operators import cleaning, masking, metrics, reports
from tallyhouse.operators import validation as V
from tallyhouse.operators.dedup import dedup_transactions
from tallyhouse.plans.daily_run import process_transactions, processed_rows, processing_report
from tallyhouse.plans.incremental import SummaryStore
from tallyhouse.plans.result_views import register_views
from tallyhouse.plans.retention import cleanup_old_data
from tallyhouse.schema import TRANSACTION_FIELDS, TRANSACTION_SCHEMA, WRITTEN_TIMESTAMP_FORMAT
from tallyhouse.session import scratch_path, size_shuffles
from tallyhouse.sinks import files, jdbc, outputs
from tallyhouse.sinks.landed_ids import LandedIds
from tallyhouse.sinks.outputs import OutputTarget
from tallyhouse.sources import transactions
from tallyhouse.sources.zone_map import read_mapped_range, write_zone_map
from tallyhouse.sources.event_tables import DEDUP_ORDER, read_event_transactions, table, transactions_from_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RANGE = ("2024-01-10", "2024-01-20")
ONE_DAY = (2024, 1, 15)
MERCHANT = "merch_000"
RETENTION_NOW = "2024-01-31 00:00:00"
RETENTION_DAYS = 14
JOB_DATE = "2024-01-30"


def query(function: Query) -> Query:
    """Register under the function's name: clock in UTC, shuffles sized for the tables."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        result = function(spark, folder)  # stages size their own shuffles
        size_shuffles(result)
        return result

    QUERIES[function.__name__] = run
    return function


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return read_event_transactions(spark, folder)


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_transactions(_raw(spark, folder))


def _flagged(spark: SparkSession, folder: str) -> DataFrame:
    return V.flag_transactions(_raw(spark, folder), order_by=DEDUP_ORDER, copies_col="copies")


def _valid(spark: SparkSession, folder: str) -> DataFrame:
    return V.valid_transactions(_flagged(spark, folder))


def _joined(df: DataFrame, *arrays: str) -> DataFrame:
    """Arrays as text, so that both engines can compare them."""
    return df.withColumns({c: F.array_join(c, ",") for c in arrays})


def _naive_times(df: DataFrame, *columns: str) -> DataFrame:
    """Times as UTC wall clock, whatever zone the reader of the result is in."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# Sources


@query
def event_transactions(spark, folder):
    return _raw(spark, folder)


@query
def read_date_range(spark, folder):
    """The range is also put on the stored ``ts``, where Parquet can skip row groups."""
    events = transactions.filter_date_range(table(spark, folder, "events"), *RANGE, column="ts")
    raw = transactions_from_events(events, table(spark, folder, "nation"))
    return transactions.filter_date_range(raw, *RANGE)


def _landed_json(spark: SparkSession, folder: str) -> str:
    return _landed(spark, _raw(spark, folder))


def _landed(spark: SparkSession, raw: DataFrame) -> str:
    """Raw transactions as JSON Lines below ``year=/month=/day=``, as producers deliver them."""
    landed = F.col("landing_date")
    delivered = raw.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSACTION_SCHEMA],
        *[F.date_format(landed, p).alias(n) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))],
    )
    root = scratch_path(spark, "landing")
    files.write_json(delivered, root, transactions.PARTITION_COLUMNS)
    return root


@query
def json_transactions(spark, folder):
    raw = transactions.read_transactions(spark, _landed_json(spark, folder), multi_line=False)
    return _naive_times(raw.select(*TRANSACTION_FIELDS, *transactions.PARTITION_COLUMNS), "timestamp")


@query
def json_one_day(spark, folder):
    root = _landed_json(spark, folder)
    raw = transactions.read_by_date(spark, root, *ONE_DAY, mode="s3", multi_line=False)
    return _naive_times(raw.select(*TRANSACTION_FIELDS), "timestamp")


@query
def json_multi_line(spark, folder):
    """Every day as one JSON array in a single file, without line breaks, read by many tasks."""
    raw = _raw(spark, folder).select("landing_date", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSACTION_SCHEMA])
    fields = F.struct(*TRANSACTION_FIELDS)
    record = F.to_json(fields, {"timestampFormat": WRITTEN_TIMESTAMP_FORMAT, "timeZone": "UTC"})
    # Rows of a day are written in a row by one task: the first opens the array, the last closes it.
    day = Window.partitionBy("landing_date").orderBy("record")
    rows = raw.select("landing_date", record.alias("record")).withColumns(
        {"place": F.row_number().over(day), "total": F.count(F.lit(1)).over(Window.partitionBy("landing_date"))}
    )
    opened = F.concat(F.when(F.col("place") == 1, "[").otherwise(","), "record")
    text = F.concat(opened, F.when(F.col("place") == F.col("total"), "]").otherwise(""))
    root = scratch_path(spark, "arrays")
    ordered = rows.withColumn("value", text).repartition("landing_date").sortWithinPartitions("landing_date", "place")
    ordered.select("landing_date", "value").write.option("lineSep", " ").partitionBy("landing_date").text(root)
    raw = transactions.read_transactions(spark, root)
    return _naive_times(raw.select(*TRANSACTION_FIELDS), "timestamp")


@query
def json_local_day(spark, folder):
    """One day under a name of its own, as the local mode has it."""
    root, day = scratch_path(spark, "local-days"), dt.date(*ONE_DAY)
    raw = _raw(spark, folder).filter(F.col("landing_date") == F.lit(day))
    files.write_json(raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSACTION_SCHEMA]), f"{root}/{day:%Y_%m_%d}.json")
    raw = transactions.read_by_date(spark, root, *ONE_DAY, mode="local")
    return _naive_times(raw.select(*TRANSACTION_FIELDS), "timestamp")


@query
def json_range_zone_map(spark, folder):
    """A range of times where one record in fifty landed two weeks late; files outside the range are not read."""
    late = F.when(F.col("ingest_seq") % 50 == 7, F.col("timestamp") - F.expr("INTERVAL 14 DAYS")).otherwise(F.col("timestamp"))
    root = _landed(spark, _raw(spark, folder).withColumn("timestamp", late))
    zones = scratch_path(spark, "zones")
    write_zone_map(spark, root, zones, multi_line=False)
    return _naive_times(read_mapped_range(spark, root, zones, *RANGE, multi_line=False).select(*TRANSACTION_FIELDS), "timestamp")


@query
def json_date_range(spark, folder):
    root = _landed_json(spark, folder)
    raw = transactions.read_date_range(spark, root, *RANGE, multi_line=False)
    return _naive_times(raw.select(*TRANSACTION_FIELDS), "timestamp")


@query
def json_fractional_times(spark, folder):
    """Times with microseconds, written as JSON and read back."""
    raw = _raw(spark, folder).withColumn("timestamp", F.expr("timestampadd(MICROSECOND, ingest_seq * 7919 % 1000000, timestamp)"))
    path = scratch_path(spark, "fractions")
    files.write_json(raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSACTION_SCHEMA]), path)
    back = transactions.read_transactions(spark, path, multi_line=False)
    return _naive_times(back.select("transaction_id", "timestamp"), "timestamp")


@query
def data_availability(spark, folder):
    """Whether there are records: in the landing folder, and in one that does not exist."""
    root = _landed_json(spark, folder)
    places = [("landed", root), ("missing", f"{root}-missing")]
    found = [
        spark.range(1).select(
            F.lit(name).alias("place"), F.lit(transactions.data_available(spark, path, multi_line=False)).alias("available")
        )
        for name, path in places
    ]
    return reduce(DataFrame.unionByName, found)


# Cleaning


@query
def trim_strings(spark, folder):
    return cleaning.trim_strings(_raw(spark, folder))


@query
def upper_currency(spark, folder):
    return cleaning.upper_currency(_raw(spark, folder)).select("ingest_seq", "currency")


@query
def digits_only_card(spark, folder):
    return cleaning.digits_only_card(_raw(spark, folder)).select("ingest_seq", "card_number")


@query
def cast_amount(spark, folder):
    return cleaning.cast_amount(_raw(spark, folder)).select("ingest_seq", "amount")


@query
def normalise_timestamp(spark, folder):
    """From the text form of the record to a timestamp."""
    raw = _raw(spark, folder)
    written = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    parsed = cleaning.normalise_timestamp(raw.select("ingest_seq", written.alias("timestamp")))
    return parsed.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query
def derive_date_hour(spark, folder):
    derived = cleaning.derive_date_hour(_raw(spark, folder))
    return derived.select("ingest_seq", "transaction_date", "transaction_hour")


@query
def clean_transactions(spark, folder):
    return _cleaned(spark, folder)


# Dedup


@query
def dedup_default_order(spark, folder):
    """Earliest timestamp first, then the remaining columns."""
    cleaned = _cleaned(spark, folder)
    return dedup_transactions(cleaned, copies_col="copies").select("transaction_id", "ingest_seq", "copies")


@query
def dedup_by_arrival(spark, folder):
    return _cleaned(spark, folder).transform(dedup_transactions, order_by=DEDUP_ORDER)


@query
def dedup_line_items(spark, folder):
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"
    )
    return dedup_transactions(
        items,
        keys=["l_orderkey", "l_linenumber"],
        order_by=["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"],
        copies_col="copies",
    )


FIRST_LANDING = "2024-01-15"


@query
def dedup_across_days(spark, folder):
    """Two landings, each free of repeats: what the first has brought is not taken from the second again."""
    cleaned = _cleaned(spark, folder)
    landed = LandedIds(scratch_path(spark, "landed-ids"))
    early = F.col("landing_date") <= F.lit(FIRST_LANDING).cast("date")
    kept = []
    for day, part in ((FIRST_LANDING, cleaned.filter(early)), (JOB_DATE, cleaned.filter(~early))):
        deduped, _ = files.stage(dedup_transactions(part, order_by=DEDUP_ORDER), "landing")
        fresh = landed.unseen(deduped, day)
        landed.record(fresh, day)
        kept.append(fresh.select("transaction_id", "ingest_seq", "landing_date"))
    return reduce(DataFrame.unionByName, kept)


# Validation


def _rule_flags(df: DataFrame, rules: list[R.Rule]) -> DataFrame:
    return df.select("ingest_seq", *[r.passed.alias(r.name) for r in rules])


@query
def rule_required(spark, folder):
    cleaned = _cleaned(spark, folder)
    return _rule_flags(cleaned, R.required_rules(cleaned.schema))


@query
def rule_amount_range(spark, folder):
    return _rule_flags(_cleaned(spark, folder), [R.amount_rule()])


@query
def rule_card_length(spark, folder):
    return _rule_flags(_cleaned(spark, folder), [R.card_rule()])


@query
def rule_currency(spark, folder):
    return _rule_flags(_cleaned(spark, folder), [R.currency_rule()])


@query
def validated_transactions(spark, folder):
    return _joined(_flagged(spark, folder), "validation_errors")


@query
def validation_counts(spark, folder):
    return V.validation_counts(_flagged(spark, folder))


@query
def validation_error_breakdown(spark, folder):
    return V.validation_error_breakdown(_flagged(spark, folder))


@query
def valid_transactions(spark, folder):
    return _valid(spark, folder)


@query
def invalid_transactions(spark, folder):
    return _joined(V.invalid_transactions(_flagged(spark, folder)), "validation_errors")


@query
def completeness_score(spark, folder):
    return V.completeness_score(_cleaned(spark, folder)).select("ingest_seq", "completeness_score")


# Masking


@query
def mask_card_number(spark, folder):
    return masking.mask_card_number(_cleaned(spark, folder)).select("ingest_seq", "card_number_masked")


@query
def hash_customer_id(spark, folder):
    return masking.hash_customer_id(_cleaned(spark, folder)).select("ingest_seq", "customer_id_hash")


@query
def transaction_hash(spark, folder):
    return masking.transaction_hash(_cleaned(spark, folder)).select("ingest_seq", "transaction_hash")


@query
def generalise_location(spark, folder):
    return masking.generalise_location(_cleaned(spark, folder)).select("ingest_seq", "location", "location_generalized")


@query
def generalise_location_to_region(spark, folder):
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    regions = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("location"), F.col("r_name").alias("region")
    )
    generalised = masking.generalise_location(_cleaned(spark, folder), regions)
    return generalised.select("ingest_seq", "location", "location_generalized")


LOCATION_ROWS = 320


@query
def generalise_location_k(spark, folder):
    """Locations of valid rows, made so coarse that at least 320 rows share each."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    regions = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("location"), F.col("r_name").alias("region")
    )
    return masking.generalise_location_k(_valid(spark, folder), regions, LOCATION_ROWS).select("ingest_seq", "location", "location_generalized")


@query
def masked_transactions(spark, folder):
    return masking.apply_all_masking(_valid(spark, folder))


@query
def secure_dataset(spark, folder):
    return masking.secure_dataset(masking.apply_all_masking(_valid(spark, folder)))


@query
def mask_production(spark, folder):
    return masking.mask_for_environment(_valid(spark, folder), "Production")


@query
def mask_staging(spark, folder):
    return masking.mask_for_environment(_valid(spark, folder), "staging")


@query
def mask_development(spark, folder):
    return masking.mask_for_environment(_valid(spark, folder), "development")


# Metrics


def _summary(df: DataFrame) -> DataFrame:
    """Without the generation time, and with arrays and deviation in comparable form."""
    readable = _joined(df, "currencies_used", "locations", "active_hours").drop("summary_generated_at")
    return readable.withColumn("std_transaction_amount", F.round("std_transaction_amount", 6))


@query
def daily_merchant_summary(spark, folder):
    return _summary(metrics.daily_merchant_summary(_valid(spark, folder)))


@query
def risk_metrics(spark, folder):
    return metrics.risk_metrics(_valid(spark, folder))


@query
def hourly_patterns(spark, folder):
    return metrics.hourly_patterns(_valid(spark, folder))


@query
def currency_breakdown(spark, folder):
    return metrics.currency_breakdown(_valid(spark, folder))


@query
def merchant_kpis(spark, folder):
    return metrics.merchant_kpis(_valid(spark, folder))


def _staged_summaries(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All summaries from one pass: valid rows and their rollup are stored once."""
    needed = ["transaction_id", "customer_id", "amount", "timestamp", "completeness_score", "transaction_hour"]
    valid, _ = files.stage(_valid(spark, folder).select(*needed, *metrics.ROLLUP_KEYS), "valid")
    rollup, _ = files.stage(metrics.activity_rollup(valid), "rollup")
    day, _ = files.stage(metrics.with_reach(metrics.merchant_day(rollup), metrics.customer_reach(valid)), "merchant-day")
    return metrics.comprehensive_summary(valid, rollup, day)


SUMMARY_KEYS = ["merchant_id", "transaction_date", "part"]


def _long(summaries: dict[str, DataFrame]) -> DataFrame:
    """All summaries in one frame: keys, measure, and its value as text."""
    frames = []
    for name, frame in summaries.items():
        if name == "daily_merchant_summary":
            frame = _naive_times(_summary(frame), "first_transaction_time", "last_transaction_time")
            frame = frame.withColumn("std_transaction_amount", F.col("std_transaction_amount").cast("decimal(18,6)"))
            frame = frame.withColumn("avg_data_quality_score", F.col("avg_data_quality_score").cast("decimal(3,2)"))
        if name == "merchant_kpis":
            frame = frame.withColumn("data_quality_score", F.col("data_quality_score").cast("decimal(3,2)"))
        part = {"hourly_patterns": "transaction_hour", "currency_breakdown": "currency"}.get(name)
        frame = frame.withColumn("part", F.col(part).cast("string") if part else F.lit("")).drop(*([part] if part else []))
        measures = [c for c in frame.columns if c not in SUMMARY_KEYS]
        text = frame.select(*SUMMARY_KEYS, *[F.col(c).cast("string").alias(c) for c in measures])
        frames.append(text.unpivot(SUMMARY_KEYS, measures, "measure", "value").withColumn("summary", F.lit(name)))
    return reduce(DataFrame.unionByName, frames)


@query
def comprehensive_summary(spark, folder):
    """The full contents of all summaries."""
    return _long(_staged_summaries(spark, folder))


@query
def incremental_summaries(spark, folder):
    """All summaries after two runs: the second brings a third of the records, of the same days and others."""
    valid, _ = files.stage(_valid(spark, folder), "valid")
    store = SummaryStore(scratch_path(spark, "summary-store"))
    late = F.col("ingest_seq") % 3 == 1
    store.update(valid.filter(~late), FIRST_LANDING)
    store.update(valid.filter(late), JOB_DATE)
    return _long({name: store.read(spark, name) for name in SUMMARY_CONTRACTS})


@query
def daily_transaction_summary(spark, folder):
    return reports.daily_transaction_summary(_valid(spark, folder))


@query
def data_quality_summary(spark, folder):
    return metrics.data_quality_summary(_flagged(spark, folder))


# Reports


@query
def merchant_performance_overview(spark, folder):
    """Both sides of the join are projections of one stored merchant-day frame."""
    day, _ = files.stage(metrics.merchant_day(metrics.activity_rollup(_valid(spark, folder))), "merchant-day")
    return reports.merchant_performance_overview(metrics.summary_from_day(day), metrics.risk_grades(day))


@query
def data_quality_monitoring(spark, folder):
    daily = metrics.data_quality_summary(_flagged(spark, folder), by=["landing_date"])
    return reports.data_quality_monitoring(daily.withColumnRenamed("landing_date", "processing_date"))


@query
def get_merchant_summary(spark, folder):
    return reports.get_merchant_summary(metrics.daily_merchant_summary(_valid(spark, folder)), MERCHANT, *RANGE)


@query
def retention_cleanup(spark, folder):
    """Invalid rows that survive, taking the transaction time as creation time."""
    invalid = V.invalid_transactions(_flagged(spark, folder))
    kept = reports.retained(invalid, "timestamp", RETENTION_DAYS, RETENTION_NOW)
    return kept.select("transaction_id", "timestamp")


@query
def retention_run(spark, folder):
    """What is left of stored invalid rows, created when they happened, after the old ones were deleted."""
    target = OutputTarget(scratch_path(spark, "retention"))
    invalid = masking.mask_card_number(V.invalid_transactions(_flagged(spark, folder))).withColumn("created_at", F.col("timestamp").cast("timestamp"))
    stored = contracts.INVALID.enforce(invalid.withColumn("timestamp", F.col("timestamp").cast("timestamp")))
    day = F.coalesce(F.col("transaction_date"), F.lit(JOB_DATE).cast("date"))
    files.replace_days(stored.withColumn(files.DAY, F.date_format(day, "yyyy-MM-dd")), target.path(contracts.INVALID))
    cleanup_old_data(spark, target, RETENTION_DAYS, dt.datetime.fromisoformat(RETENTION_NOW))
    left = outputs.read_output(spark, target, contracts.INVALID)
    return _naive_times(_joined(left, "validation_errors"), "timestamp").drop("created_at", files.DAY)


# Sinks and the whole job


@query
def flatten_for_jdbc(spark, folder):
    invalid = V.invalid_transactions(_flagged(spark, folder)).select("transaction_id", "validation_errors")
    return jdbc.flatten_for_jdbc(invalid)


@query
def parquet_by_day(spark, folder):
    """Written by day, then read back."""
    path = scratch_path(spark, "by-day")
    valid = _valid(spark, folder)
    files.write_parquet(valid, path, ["transaction_date"])
    return spark.read.schema(valid.schema).parquet(path)


def _finished_job(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    target = OutputTarget(scratch_path(spark, "job"))
    process_transactions(_raw(spark, folder), target, JOB_DATE, order_by=DEDUP_ORDER)
    return register_views(spark, target)


@query
def daily_job_processed(spark, folder):
    stored = _finished_job(spark, folder)["processed_transactions"]
    return _naive_times(stored.drop("created_at"), "timestamp")


@query
def daily_job_risk(spark, folder):
    return _finished_job(spark, folder)["summary_risk_metrics"]


@query
def daily_job_summary(spark, folder):
    stored = _finished_job(spark, folder)["summary_daily_merchant_summary"].drop("summary_generated_at")
    readable = _joined(stored, "currencies_used", "locations", "active_hours")
    return _naive_times(readable, "first_transaction_time", "last_transaction_time")


@query
def daily_job_hourly(spark, folder):
    return _finished_job(spark, folder)["summary_hourly_patterns"]


@query
def daily_job_currency(spark, folder):
    return _finished_job(spark, folder)["summary_currency_breakdown"]


@query
def daily_job_kpis(spark, folder):
    return _finished_job(spark, folder)["summary_merchant_kpis"]


@query
def daily_job_invalid(spark, folder):
    stored = _finished_job(spark, folder)["invalid_transactions"].drop("created_at")
    return _naive_times(_joined(stored, "validation_errors"), "timestamp")


@query
def daily_job_quality(spark, folder):
    stored = _finished_job(spark, folder)["data_quality_reports"]
    return stored.drop("processing_duration_seconds", "errors_encountered", "created_at")


@query
def daily_job_run_log(spark, folder):
    log = _finished_job(spark, folder)["pipeline_processing_logs"]
    return log.select("processing_date", "pipeline_mode", "status", "records_processed", "records_valid", "records_invalid")


def _spoiled(frames: dict[contracts.Contract, DataFrame]) -> dict[contracts.Contract, DataFrame]:
    """The tables with breaches at fixed rates: repeated keys, missing, unknown and impossible values, long texts."""
    spoil = {
        contracts.PROCESSED: {
            "merchant_id": "CASE WHEN ingest_seq % 103 = 0 THEN NULL ELSE merchant_id END",
            "location": "CASE WHEN ingest_seq % 97 = 0 THEN repeat(location, 40) ELSE location END",
        },
        contracts.RISK_METRICS: {"risk_level": "CASE WHEN transaction_velocity % 5 = 2 THEN 'ODD' ELSE risk_level END"},
        contracts.HOURLY_PATTERNS: {"transaction_hour": "CASE WHEN transaction_hour = 13 THEN 24 ELSE transaction_hour END"},
        contracts.CURRENCY_BREAKDOWN: {"currency": "CASE WHEN currency = 'GBP' THEN 'EUR' ELSE currency END"},
    }
    repeat = {contracts.PROCESSED: "ingest_seq % 101 = 0"}
    spoiled = {}
    for contract, frame in frames.items():
        frame = frame.unionByName(frame.where(repeat[contract])) if contract in repeat else frame
        spoiled[contract] = frame.withColumns({c: F.expr(e) for c, e in spoil[contract].items()})
    return spoiled


@query
def contract_audit(spark, folder):
    """All breaches of tables that were spoiled at fixed rates."""
    valid, _ = files.stage(_valid(spark, folder), "valid")
    hashed = processed_rows(masking.mask_card_number(valid)).withColumn("created_at", F.lit(RETENTION_NOW).cast("timestamp"))
    tables = {
        contracts.PROCESSED: hashed,
        contracts.RISK_METRICS: metrics.risk_metrics(valid),
        contracts.HOURLY_PATTERNS: metrics.hourly_patterns(valid),
        contracts.CURRENCY_BREAKDOWN: metrics.currency_breakdown(valid),
    }
    return contracts.contract_audit(_spoiled(tables), lengths=True)


@query
def daily_job_report(spark, folder):
    """The run in one line of figures."""
    target = OutputTarget(scratch_path(spark, "job"))
    result = process_transactions(_raw(spark, folder), target, JOB_DATE, order_by=DEDUP_ORDER)
    return spark.range(1).select(F.lit(processing_report(result)).alias("report"))


@query
def daily_job_views(spark, folder):
    """SQL text over the stored results of a run."""
    _finished_job(spark, folder)
    return spark.sql(
        """
        SELECT o.transaction_date, o.volume_category, o.risk_level, count(*) AS merchants,
               sum(o.total_transactions) AS transactions
        FROM merchant_performance_overview o
        JOIN daily_transaction_summary d ON d.transaction_date = o.transaction_date
        GROUP BY o.transaction_date, o.volume_category, o.risk_level
        """
    )
