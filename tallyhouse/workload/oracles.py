"""The same queries as SQL text for an independent engine (DuckDB).

Each statement starts from the Parquet tables and spells the whole chain out as common
table expressions; nothing is shared with the Spark side.
"""

from __future__ import annotations

# The required fields, in record order.
_FIELDS = (
    "transaction_id", "merchant_id", "card_number", "amount", "timestamp", "customer_id", "currency", "location",
)
_TEXT = tuple(f for f in _FIELDS if f not in ("amount", "timestamp"))

_RAW = """
raw AS (
  SELECT
    concat('txn', CAST(CASE WHEN event_id % 50 = 49 THEN event_id - 1 ELSE event_id END AS VARCHAR)) AS transaction_id,
    concat(' ', CASE WHEN event_id % 97 = 0 THEN concat('merch_s', CAST(event_id % 997 AS VARCHAR))
                     WHEN event_id % 3 = 0 THEN 'merch_000'
                     WHEN event_id % 9 IN (1, 2, 4, 5) THEN 'merch_001'
                     ELSE concat('merch_', lpad(CAST(user_id % 20 AS VARCHAR), 3, '0')) END, ' ') AS merchant_id,
    CASE WHEN event_id % 25 = 1 THEN '411111'
         WHEN event_id % 25 = 2 THEN CAST(NULL AS VARCHAR)
         WHEN event_id % 25 = 3 THEN concat('4111-1111-1111-', lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0'))
         ELSE concat('411111111111', lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0')) END AS card_number,
    CASE WHEN event_id % 40 = 7 THEN CAST(NULL AS DECIMAL(15,2))
         WHEN event_id % 40 = 8 THEN CAST(-1 * CAST(value AS DECIMAL(10,2)) AS DECIMAL(15,2))
         WHEN event_id % 5 = 0 AND event_id % 9 NOT IN (1, 2, 4, 5)
           THEN CAST(CAST(value AS DECIMAL(10,2)) * 50 AS DECIMAL(15,2))
         ELSE CAST(CAST(value AS DECIMAL(10,2)) * 5 AS DECIMAL(15,2)) END AS amount,
    CASE WHEN event_id % 61 = 5 THEN CAST(NULL AS TIMESTAMP) ELSE date_trunc('second', ts) END AS timestamp,
    CASE WHEN event_id % 71 = 4 THEN '   ' ELSE concat('cust_', CAST(user_id AS VARCHAR)) END AS customer_id,
    CASE WHEN event_id % 33 = 5 THEN 'XXX' WHEN event_type = 'signup' THEN 'usd' WHEN event_type = 'purchase' THEN ' EUR '
         WHEN event_type = 'view' THEN 'GBP' WHEN event_type = 'click' THEN 'JPY' ELSE 'CAD' END AS currency,
    n_name AS location,
    event_id AS ingest_seq,
    CAST(ts AS DATE) AS landing_date
  FROM events JOIN nation ON n_nationkey = user_id % 25
)"""

_CLEANED = """
cleaned AS (
  SELECT
    trim(transaction_id) AS transaction_id,
    trim(merchant_id) AS merchant_id,
    regexp_replace(trim(card_number), '[^0-9]', '', 'g') AS card_number,
    CAST(amount AS DOUBLE) AS amount,
    timestamp,
    trim(customer_id) AS customer_id,
    upper(trim(currency)) AS currency,
    trim(location) AS location,
    ingest_seq,
    landing_date,
    CAST(timestamp AS DATE) AS transaction_date,
    CAST(hour(timestamp) AS INTEGER) AS transaction_hour
  FROM raw
)"""

_DEDUPED = """
deduped AS (
  SELECT * FROM cleaned QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingest_seq) = 1
)"""

_COPIES = """
copies AS (SELECT transaction_id AS copy_id, count(*) AS copies FROM cleaned GROUP BY transaction_id)"""


def _present(field: str) -> str:
    return f"({field} IS NOT NULL AND {field} <> '')" if field in _TEXT else f"{field} IS NOT NULL"


_RULES = {f"missing_{f}": _present(f) for f in _FIELDS} | {
    "amount_out_of_range": "coalesce(amount >= 0.01 AND amount <= 10000, false)",
    "card_number_length": "coalesce(length(card_number) = 16, false)",
    "currency_not_allowed": "coalesce(currency IN ('USD', 'EUR', 'GBP', 'CAD', 'AUD', 'JPY'), false)",
}
_ERRORS = ", ".join(f"CASE WHEN NOT ({test}) THEN '{name}' END" for name, test in _RULES.items())
_SCORE = "(" + " + ".join(f"CASE WHEN {_present(f)} THEN 1 ELSE 0 END" for f in _FIELDS) + ") / 8.0"

_FLAGGED = f"""
flagged AS (
  SELECT deduped.*, copies.copies,
    {" AND ".join(_RULES.values())} AS is_valid,
    concat_ws(',', {_ERRORS}) AS validation_errors,
    CAST({_SCORE} AS DOUBLE) AS completeness_score
  FROM deduped JOIN copies ON copy_id = transaction_id
)"""

_VALID = """
valid AS (
  SELECT * EXCLUDE (is_valid, validation_errors) REPLACE (CAST(amount AS DECIMAL(15,2)) AS amount),
    CAST(CAST(amount AS DECIMAL(15,2)) * 100 AS BIGINT) AS cents
  FROM flagged WHERE is_valid
)"""


def _half_up(numerator: str, denominator: str) -> str:
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def _money(cents: str, precision: int = 15) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL({precision},2))"


def _average(cents: str, rows: str, precision: int = 10) -> str:
    return _money(_half_up(cents, rows), precision)


_HASH = """sha256(concat(transaction_id, merchant_id, CAST(CAST(amount AS DOUBLE) AS VARCHAR),
    CAST(timestamp AS VARCHAR)))"""
_MASK = """CASE WHEN length(card_number) >= 4 THEN concat('************', right(card_number, 4))
    ELSE '****************' END"""

_DAILY = f"""
daily AS (
  SELECT merchant_id, transaction_date,
    count(transaction_id) AS total_transactions,
    {_money("sum(cents)")} AS total_amount,
    {_average("sum(cents)", "count(cents)")} AS avg_transaction_amount,
    CAST(min(amount) AS DECIMAL(10,2)) AS min_transaction_amount,
    CAST(max(amount) AS DECIMAL(10,2)) AS max_transaction_amount,
    round(stddev_samp(CAST(amount AS DOUBLE)), 6) AS std_transaction_amount,
    count(customer_id) AS total_customers,
    string_agg(DISTINCT currency, ',' ORDER BY currency) AS currencies_used,
    string_agg(DISTINCT location, ',' ORDER BY location) AS locations,
    string_agg(DISTINCT strftime(timestamp, '%H'), ',' ORDER BY strftime(timestamp, '%H')) AS active_hours,
    CAST(count(DISTINCT currency) AS INTEGER) AS currency_count,
    CAST(count(DISTINCT location) AS INTEGER) AS location_count,
    CAST(count(DISTINCT transaction_hour) AS INTEGER) AS active_hour_count,
    avg(completeness_score) AS avg_data_quality_score,
    min(timestamp) AS first_transaction_time,
    max(timestamp) AS last_transaction_time
  FROM valid GROUP BY merchant_id, transaction_date
)"""

_RATIO = _half_up("10000 * max(cents)", "sum(cents)")
_RISK = f"""
risk AS (
  SELECT *, CASE WHEN risk_score >= 8 THEN 'HIGH' WHEN risk_score >= 6 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM (
    SELECT merchant_id, transaction_date,
      count(*) FILTER (WHERE amount > 1000) AS high_value_transactions,
      count(*) FILTER (WHERE amount > 5000) AS very_high_value_transactions,
      count(transaction_id) AS transaction_velocity,
      CAST(max(amount) AS DECIMAL(15,2)) AS max_single_transaction,
      CAST(CAST({_RATIO} AS DECIMAL(20,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(5,4)) AS max_transaction_ratio,
      count(DISTINCT location) AS unique_locations,
      count(DISTINCT customer_id) AS unique_customers,
      CASE WHEN count(*) FILTER (WHERE amount > 5000) > 5 THEN 10
           WHEN count(*) FILTER (WHERE amount > 1000) > 10 THEN 8
           WHEN count(transaction_id) > 100 THEN 6
           WHEN 10 * max(cents) > 8 * sum(cents) THEN 7
           ELSE 3 END AS risk_score
    FROM valid GROUP BY merchant_id, transaction_date
  )
)"""

_KPIS = f"""
kpis AS (
  SELECT merchant_id, transaction_date,
    count(transaction_id) AS transaction_count,
    {_money("sum(cents)")} AS gross_volume,
    {_average("sum(cents)", "count(cents)")} AS average_ticket_size,
    {_average("sum(cents)", "count(transaction_id)")} AS revenue_per_transaction,
    count(customer_id) AS customer_count,
    {_average("sum(cents)", "count(customer_id)")} AS revenue_per_customer,
    CAST(count(DISTINCT location) AS INTEGER) AS active_locations,
    CAST(count(DISTINCT transaction_hour) AS INTEGER) AS operating_hours,
    avg(completeness_score) AS data_quality_score
  FROM valid GROUP BY merchant_id, transaction_date
)"""


def _breakdown(name: str, key: str, prefix: str) -> str:
    return f"""
{name} AS (
  SELECT merchant_id, transaction_date, {key},
    count(transaction_id) AS {prefix}_transactions,
    {_money("sum(cents)")} AS {prefix}_amount,
    {_average("sum(cents)", "count(cents)")} AS {prefix}_avg_amount
  FROM valid GROUP BY merchant_id, transaction_date, {key}
)"""


_HOURLY = _breakdown("hourly", "transaction_hour", "hourly")
_CURRENCY = _breakdown("by_currency", "currency", "currency")

_BY_DAY = f"""
by_day AS (
  SELECT transaction_date,
    count(*) AS total_transactions,
    {_money("sum(cents)", 21)} AS total_volume,
    {_average("sum(cents)", "count(cents)", 15)} AS avg_transaction_size,
    count(DISTINCT merchant_id) AS active_merchants,
    count(DISTINCT location) AS active_locations,
    count(DISTINCT currency) AS currencies_used
  FROM valid GROUP BY transaction_date
)"""

# Volume categories and their limits.
_OVERVIEW = """
overview AS (
  SELECT d.merchant_id, d.transaction_date, d.total_transactions, d.total_amount, d.avg_transaction_amount,
    r.risk_level, r.risk_score,
    CASE WHEN d.total_transactions > 100 AND d.total_amount > 10000 THEN 'HIGH_VOLUME'
         WHEN d.total_transactions > 50 AND d.total_amount > 5000 THEN 'MEDIUM_VOLUME'
         ELSE 'LOW_VOLUME' END AS volume_category
  FROM daily d LEFT JOIN risk r ON d.merchant_id = r.merchant_id AND d.transaction_date = r.transaction_date
)"""


def _percent(whole: str) -> str:
    return _money(_half_up("10000 * count(*) FILTER (WHERE is_valid)", whole), 5)


_QUALITY = f"""
    CAST(sum(copies) AS BIGINT) AS raw_transactions,
    count(*) FILTER (WHERE is_valid) AS valid_transactions,
    count(*) FILTER (WHERE NOT is_valid) AS invalid_transactions,
    count(*) AS total_transactions,
    {_percent("sum(copies)")} AS pct_of_raw,
    {_percent("count(*)")} AS data_quality_percentage"""

_RANGE = "timestamp >= TIMESTAMP '2024-01-10 00:00:00' AND timestamp < TIMESTAMP '2024-01-21 00:00:00'"
_JSON_FIELDS = """transaction_id, merchant_id, card_number, CAST(amount AS DOUBLE) AS amount, timestamp,
    customer_id, currency, location"""

_CHAIN = [_RAW, _CLEANED, _DEDUPED, _COPIES, _FLAGGED, _VALID]


def _from_raw(select: str) -> str:
    return f"WITH {_RAW}\n{select}"


def _from_cleaned(select: str) -> str:
    return f"WITH {', '.join(_CHAIN[:2])}\n{select}"


def _from_flagged(select: str) -> str:
    return f"WITH {', '.join(_CHAIN[:5])}\n{select}"


def _from_valid(select: str, *more: str) -> str:
    return f"WITH {', '.join([*_CHAIN, *more])}\n{select}"


def _rule_columns(*names: str) -> str:
    return ", ".join(f"{_RULES[n]} AS {n}" for n in names)


_PLAIN_VALID = "SELECT * EXCLUDE (cents) FROM valid"
_MASKED = f"""SELECT * EXCLUDE (cents, card_number, customer_id), {_MASK} AS card_number_masked,
    sha256(customer_id) AS customer_id_hash, {_HASH} AS transaction_hash FROM valid"""

_DAILY_TEXT = """
    SELECT * REPLACE (CAST(std_transaction_amount AS DECIMAL(18,6)) AS std_transaction_amount,
                      CAST(avg_data_quality_score AS DECIMAL(3,2)) AS avg_data_quality_score) FROM daily"""
_KPIS_TEXT = "SELECT * REPLACE (CAST(data_quality_score AS DECIMAL(3,2)) AS data_quality_score) FROM kpis"


def _unpivoted(name: str, rows: str, part: str | None = None) -> str:
    """Keys, measure, and its value as text."""
    columns = f"CAST({part} AS VARCHAR) AS part, CAST(COLUMNS(* EXCLUDE (merchant_id, transaction_date, {part})) AS VARCHAR)" if part else (
        "'' AS part, CAST(COLUMNS(* EXCLUDE (merchant_id, transaction_date)) AS VARCHAR)"
    )
    return f"""SELECT '{name}' AS summary, merchant_id, transaction_date, part, measure, value
        FROM (SELECT merchant_id, transaction_date, {columns} FROM ({rows}))
        UNPIVOT INCLUDE NULLS (value FOR measure IN (COLUMNS(* EXCLUDE (merchant_id, transaction_date, part))))"""


_LONG = " UNION ALL ".join([
    _unpivoted("daily_merchant_summary", _DAILY_TEXT),
    _unpivoted("risk_metrics", "SELECT * FROM risk"),
    _unpivoted("hourly_patterns", "SELECT * FROM hourly", "transaction_hour"),
    _unpivoted("currency_breakdown", "SELECT * FROM by_currency", "currency"),
    _unpivoted("merchant_kpis", _KPIS_TEXT),
])

ORACLES: dict[str, str] = {
    "event_transactions": _from_raw("SELECT * FROM raw"),
    "read_date_range": _from_raw(f"SELECT * FROM raw WHERE {_RANGE}"),
    "json_transactions": _from_raw(
        f"""SELECT {_JSON_FIELDS}, CAST(year(landing_date) AS INTEGER) AS year,
            CAST(month(landing_date) AS INTEGER) AS month, CAST(day(landing_date) AS INTEGER) AS day FROM raw"""
    ),
    "json_one_day": _from_raw(f"SELECT {_JSON_FIELDS} FROM raw WHERE landing_date = DATE '2024-01-15'"),
    "json_date_range": _from_raw(f"SELECT {_JSON_FIELDS} FROM raw WHERE {_RANGE}"),
    "json_multi_line": _from_raw(f"SELECT {_JSON_FIELDS} FROM raw"),
    "json_local_day": _from_raw(f"SELECT {_JSON_FIELDS} FROM raw WHERE landing_date = DATE '2024-01-15'"),
    "json_range_zone_map": _from_raw(
        f"""SELECT {_JSON_FIELDS} FROM (
            SELECT * REPLACE (CASE WHEN ingest_seq % 50 = 7 THEN timestamp - INTERVAL 14 DAY ELSE timestamp END AS timestamp) FROM raw
        ) WHERE {_RANGE}"""
    ),
    "trim_strings": _from_raw(
        f"SELECT * REPLACE ({', '.join(f'trim({c}) AS {c}' for c in _TEXT)}) FROM raw"
    ),
    "upper_currency": _from_raw("SELECT ingest_seq, upper(currency) AS currency FROM raw"),
    "digits_only_card": _from_raw(
        "SELECT ingest_seq, regexp_replace(card_number, '[^0-9]', '', 'g') AS card_number FROM raw"
    ),
    "cast_amount": _from_raw("SELECT ingest_seq, CAST(amount AS DOUBLE) AS amount FROM raw"),
    "normalise_timestamp": _from_raw("SELECT ingest_seq, timestamp FROM raw"),
    "derive_date_hour": _from_raw(
        """SELECT ingest_seq, CAST(timestamp AS DATE) AS transaction_date,
            CAST(hour(timestamp) AS INTEGER) AS transaction_hour FROM raw"""
    ),
    "clean_transactions": _from_cleaned("SELECT * FROM cleaned"),
    "dedup_default_order": _from_cleaned(
        """SELECT transaction_id, ingest_seq, count(*) OVER (PARTITION BY transaction_id) AS copies FROM cleaned
        QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY timestamp ASC NULLS LAST,
          merchant_id NULLS FIRST, card_number NULLS FIRST, amount NULLS FIRST, customer_id NULLS FIRST,
          currency NULLS FIRST, location NULLS FIRST, ingest_seq) = 1"""
    ),
    "dedup_by_arrival": f"WITH {', '.join(_CHAIN[:3])}\nSELECT * FROM deduped",
    "dedup_line_items": """
        SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey, l_suppkey,
          count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate, l_extendedprice, l_partkey, l_suppkey) = 1""",
    "rule_required": _from_cleaned(
        f"SELECT ingest_seq, {_rule_columns(*[f'missing_{f}' for f in _FIELDS])} FROM cleaned"
    ),
    "rule_amount_range": _from_cleaned(f"SELECT ingest_seq, {_rule_columns('amount_out_of_range')} FROM cleaned"),
    "rule_card_length": _from_cleaned(f"SELECT ingest_seq, {_rule_columns('card_number_length')} FROM cleaned"),
    "rule_currency": _from_cleaned(f"SELECT ingest_seq, {_rule_columns('currency_not_allowed')} FROM cleaned"),
    "validated_transactions": _from_flagged("SELECT * FROM flagged"),
    "validation_counts": _from_flagged("SELECT is_valid, count(*) AS transactions FROM flagged GROUP BY is_valid"),
    "validation_error_breakdown": _from_flagged(
        """SELECT validation_error, count(*) AS failures
        FROM (SELECT unnest(string_split(validation_errors, ',')) AS validation_error FROM flagged WHERE NOT is_valid)
        GROUP BY validation_error"""
    ),
    "valid_transactions": _from_valid(_PLAIN_VALID),
    "invalid_transactions": _from_flagged("SELECT * EXCLUDE (is_valid) FROM flagged WHERE NOT is_valid"),
    "completeness_score": _from_cleaned(
        f"SELECT ingest_seq, CAST({_SCORE} AS DOUBLE) AS completeness_score FROM cleaned"
    ),
    "mask_card_number": _from_cleaned(f"SELECT ingest_seq, {_MASK} AS card_number_masked FROM cleaned"),
    "hash_customer_id": _from_cleaned("SELECT ingest_seq, sha256(customer_id) AS customer_id_hash FROM cleaned"),
    "transaction_hash": _from_cleaned(
        f"""SELECT ingest_seq, CASE WHEN amount IS NOT NULL AND timestamp IS NOT NULL THEN {_HASH} END
            AS transaction_hash FROM cleaned"""
    ),
    "generalise_location": _from_cleaned(
        "SELECT ingest_seq, location, location AS location_generalized FROM cleaned"
    ),
    "generalise_location_to_region": _from_cleaned(
        """SELECT ingest_seq, location, r_name AS location_generalized
        FROM cleaned JOIN nation ON n_name = location JOIN region ON r_regionkey = n_regionkey"""
    ),
    "masked_transactions": _from_valid(_MASKED),
    "secure_dataset": _from_valid(
        f"""SELECT transaction_id, merchant_id, amount, currency, timestamp, transaction_date, transaction_hour,
            location, completeness_score, {_HASH} AS transaction_hash FROM valid"""
    ),
    "mask_production": _from_valid(_MASKED),
    "mask_staging": _from_valid(
        f"SELECT * EXCLUDE (cents), {_MASK} AS card_number_masked, {_HASH} AS transaction_hash FROM valid"
    ),
    "mask_development": _from_valid(f"SELECT * EXCLUDE (cents), {_MASK} AS card_number_masked FROM valid"),
    "daily_merchant_summary": _from_valid("SELECT * FROM daily", _DAILY),
    "risk_metrics": _from_valid("SELECT * FROM risk", _RISK),
    "hourly_patterns": _from_valid("SELECT * FROM hourly", _HOURLY),
    "currency_breakdown": _from_valid("SELECT * FROM by_currency", _CURRENCY),
    "merchant_kpis": _from_valid("SELECT * FROM kpis", _KPIS),
    "comprehensive_summary": _from_valid(_LONG, _DAILY, _RISK, _HOURLY, _CURRENCY, _KPIS),
    "incremental_summaries": _from_valid(_LONG, _DAILY, _RISK, _HOURLY, _CURRENCY, _KPIS),
    "daily_transaction_summary": _from_valid("SELECT * FROM by_day ORDER BY transaction_date DESC", _BY_DAY),
    "data_quality_summary": _from_flagged(f"SELECT {_QUALITY} FROM flagged"),
    "merchant_performance_overview": _from_valid(
        "SELECT * FROM overview ORDER BY transaction_date DESC, total_amount DESC", _DAILY, _RISK, _OVERVIEW
    ),
    # Quality grades and their limits.
    "data_quality_monitoring": _from_flagged(
        f"""SELECT processing_date, total_transactions, valid_transactions, invalid_transactions,
            data_quality_percentage,
            CASE WHEN data_quality_percentage >= 95 THEN 'EXCELLENT' WHEN data_quality_percentage >= 90 THEN 'GOOD'
                 WHEN data_quality_percentage >= 85 THEN 'ACCEPTABLE' ELSE 'NEEDS_ATTENTION' END AS quality_status
        FROM (SELECT landing_date AS processing_date, {_QUALITY} FROM flagged GROUP BY landing_date)
        ORDER BY processing_date DESC"""
    ),
    "get_merchant_summary": _from_valid(
        """SELECT merchant_id, transaction_date, total_transactions, total_amount, avg_transaction_amount,
            total_customers, currency_count, location_count
        FROM daily
        WHERE merchant_id = 'merch_000' AND transaction_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
        ORDER BY transaction_date""",
        _DAILY,
    ),
    "retention_cleanup": _from_flagged(
        """SELECT transaction_id, timestamp FROM flagged WHERE NOT is_valid
        AND NOT coalesce(timestamp < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY, false)"""
    ),
    "flatten_for_jdbc": _from_flagged(
        """SELECT transaction_id, concat('["', replace(validation_errors, ',', '","'), '"]') AS validation_errors
        FROM flagged WHERE NOT is_valid"""
    ),
    "dedup_across_days": _from_cleaned(
        """SELECT transaction_id, ingest_seq, landing_date FROM cleaned QUALIFY row_number() OVER
            (PARTITION BY transaction_id ORDER BY landing_date > DATE '2024-01-15', ingest_seq) = 1"""
    ),
    "parquet_by_day": _from_valid(_PLAIN_VALID),
    "daily_job_processed": _from_valid(
        f"""SELECT transaction_id, merchant_id, {_MASK} AS card_number_masked, amount, currency, timestamp,
            sha256(customer_id) AS customer_id_hash, location, transaction_date, transaction_hour,
            CAST(completeness_score AS DECIMAL(3,2)) AS completeness_score, {_HASH} AS transaction_hash,
            DATE '2024-01-30' AS date FROM valid"""
    ),
    "daily_job_risk": _from_valid("SELECT *, DATE '2024-01-30' AS date FROM risk", _RISK),
    "daily_job_summary": _from_valid(
        """SELECT * REPLACE (CAST(std_transaction_amount AS DECIMAL(10,2)) AS std_transaction_amount,
            CAST(avg_data_quality_score AS DECIMAL(3,2)) AS avg_data_quality_score), DATE '2024-01-30' AS date FROM daily""",
        _DAILY,
    ),
    "daily_job_hourly": _from_valid("SELECT *, DATE '2024-01-30' AS date FROM hourly", _HOURLY),
    "daily_job_currency": _from_valid("SELECT *, DATE '2024-01-30' AS date FROM by_currency", _CURRENCY),
    "daily_job_kpis": _from_valid(
        """SELECT * REPLACE (CAST(data_quality_score AS DECIMAL(3,2)) AS data_quality_score), DATE '2024-01-30' AS date
        FROM kpis""",
        _KPIS,
    ),
    "daily_job_invalid": _from_flagged(
        f"""SELECT transaction_id, merchant_id, {_MASK} AS card_number_masked, CAST(amount AS DOUBLE) AS amount, currency,
            timestamp, customer_id, location, transaction_date, validation_errors, DATE '2024-01-30' AS date
        FROM flagged WHERE NOT is_valid"""
    ),
    "generalise_location_k": _from_valid(
        """SELECT ingest_seq, valid.location, label AS location_generalized FROM valid JOIN labels ON labels.location = valid.location""",
        """counted AS (
        SELECT location, any_value(r_name) AS region, count(*) AS n
        FROM valid JOIN nation ON n_name = location JOIN region ON r_regionkey = n_regionkey GROUP BY location
        ), rare AS (
        SELECT *, sum(n) OVER (PARTITION BY region) AS of_region FROM counted WHERE n < 320
        ), labels AS (
        SELECT location, location AS label FROM counted WHERE n >= 320
        UNION ALL SELECT location, CASE WHEN of_region >= 320 THEN region
            WHEN sum(CASE WHEN of_region < 320 THEN n END) OVER () >= 320 THEN '*' END FROM rare)""",
    ),
    "daily_job_report": _from_flagged(
        """SELECT concat('2024-01-30: read ', raw, ', dropped ', raw - valid - invalid, ' repeats, stored ', valid, ' valid (',
            printf('%.2f', valid / raw * 100), ' % of those read) and ', invalid, ' invalid rows, 5 summary tables') AS report
        FROM (SELECT CAST(sum(copies) AS BIGINT) AS raw, count(*) FILTER (WHERE is_valid) AS valid,
            count(*) FILTER (WHERE NOT is_valid) AS invalid FROM flagged)"""
    ),
    "retention_run": _from_flagged(
        f"""SELECT transaction_id, merchant_id, {_MASK} AS card_number_masked, CAST(amount AS DOUBLE) AS amount, currency,
            timestamp, customer_id, location, transaction_date, validation_errors
        FROM flagged WHERE NOT is_valid
        AND NOT coalesce(timestamp < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY, false)"""
    ),
    "daily_job_quality": _from_flagged(
        f"SELECT DATE '2024-01-30' AS processing_date, {_QUALITY}, DATE '2024-01-30' AS date FROM flagged"
    ),
    "daily_job_run_log": _from_flagged(
        """SELECT DATE '2024-01-30' AS processing_date, 'batch' AS pipeline_mode, 'SUCCESS' AS status,
            CAST(sum(copies) AS BIGINT) AS records_processed, count(*) FILTER (WHERE is_valid) AS records_valid,
            count(*) FILTER (WHERE NOT is_valid) AS records_invalid
        FROM flagged"""
    ),
    "json_fractional_times": _from_raw(
        """SELECT transaction_id, timestamp + to_microseconds(ingest_seq * 7919 % 1000000) AS timestamp FROM raw"""
    ),
    "data_availability": """SELECT 'landed' AS place, count(*) > 0 AS available FROM events
        UNION ALL SELECT 'missing', false""",
    "contract_audit": _from_valid(
        """SELECT * FROM (
        SELECT 'processed_transactions' AS "table", 'merchant_id is null' AS breach, count(*) AS rows FROM spoiled WHERE merchant_id IS NULL
        UNION ALL SELECT 'processed_transactions', 'location is too long', count(*) FROM spoiled WHERE length(location) > 100
        UNION ALL SELECT 'processed_transactions', 'key is repeated', count(*) - count(DISTINCT transaction_id) FROM spoiled
        UNION ALL SELECT 'risk_metrics', 'risk level is unknown', count(*) FROM risk WHERE transaction_velocity % 5 = 2
        UNION ALL SELECT 'hourly_patterns', 'hour is outside 0-23', count(*) FROM hourly WHERE transaction_hour = 13
        UNION ALL SELECT 'currency_breakdown', 'key is repeated', count(*) - count(DISTINCT (merchant_id, transaction_date))
            FROM by_currency WHERE currency IN ('GBP', 'EUR')
        ) WHERE rows > 0""",
        _RISK, _HOURLY, _CURRENCY,
        """spoiled AS (
        SELECT transaction_id, CASE WHEN ingest_seq % 103 <> 0 THEN merchant_id END AS merchant_id,
            CASE WHEN ingest_seq % 97 = 0 THEN repeat(location, 40) ELSE location END AS location
        FROM (SELECT * FROM valid UNION ALL SELECT * FROM valid WHERE ingest_seq % 101 = 0))""",
    ),
    "daily_job_views": _from_valid(
        """SELECT transaction_date, volume_category, risk_level, count(*) AS merchants,
            CAST(sum(total_transactions) AS BIGINT) AS transactions
        FROM overview GROUP BY transaction_date, volume_category, risk_level""",
        _DAILY, _RISK, _OVERVIEW,
    ),
}
