"""Output contracts: the columns, types, keys and checks of every stored table."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractViolation(ValueError):
    """Rows that do not meet the contract of the table they were meant for."""


@dataclass(frozen=True, eq=False)
class Contract:
    table: str
    columns: dict[str, str]
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    checks: dict[str, tuple[str, str]] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    # How stored files are laid out for look-ups: see ``files.replace_days``.
    cluster_by: tuple[str, ...] = ()
    find_by: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in self.columns.items()))

    def conform(self, df: DataFrame) -> DataFrame:
        """Exactly the contract's columns and types. A missing column or a bad cast raises."""
        return df.select(*[F.col(c).cast(t).alias(c) for c, t in self.columns.items()])

    def _conditions(self, lengths: bool) -> dict[str, tuple[str, Column]]:
        """Per rule: the column it guards and the condition a good row meets."""
        rules = {f"{c} is null": (c, F.col(c).isNotNull()) for c in dict.fromkeys((*self.key, *self.not_null))}
        rules |= {label: (c, F.expr(condition)) for label, (c, condition) in self.checks.items()}
        if lengths:
            rules |= {f"{c} is too long": (c, F.length(c) <= n) for c, n in self.lengths.items()}
        return rules

    def enforce(self, df: DataFrame, lengths: bool = False) -> DataFrame:
        """Conform, and make every task raise on a row that breaks a rule.

        The test rides along with whatever reads the result, usually the write, so it
        costs no pass of its own. A NULL condition passes, as in SQL CHECK. Keys are not
        compared across rows: dedup and grouping make them unique; ``check`` verifies it.
        ``lengths`` adds the column widths of a relational target.
        """
        frame = self.conform(df)
        guarded: dict[str, Column] = {}
        for label, (column, condition) in self._conditions(lengths).items():
            value = guarded.get(column, F.col(column))
            failure = F.raise_error(F.lit(f"{self.table}: {label}"))
            guarded[column] = F.when(F.coalesce(condition, F.lit(True)), value).otherwise(failure)
        return frame.withColumns(guarded) if guarded else frame

    def breaches(self, df: DataFrame, lengths: bool = False) -> DataFrame:
        """(table, breach, rows): every rule with the rows that break it, and repeated keys with the rows too many.

        Nothing is raised and nothing collected. Rules are counted in one aggregate. For keys, each
        map task sends one row per key it holds, and the counts of all partitions meet by key; rows
        of a key that is not whole are the null rule's matter.
        """
        rules = {
            label: F.count_if(~F.coalesce(condition, F.lit(True))) for label, (_, condition) in self._conditions(lengths).items()
        }
        found = []
        if rules:
            counted = df.agg(F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("k"), n.alias("n")) for k, n in rules.items()])).alias("rules"))
            found.append(counted.select(F.explode("rules").alias("breach", "rows")))
        if self.key:
            whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.key])
            keys = df.where(whole).groupBy(*self.key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            found.append(keys.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows")).select(F.lit("key is repeated").alias("breach"), "rows"))
        if not found:
            raise ValueError(f"{self.table} has no rules")
        return reduce(DataFrame.unionByName, found).select(F.lit(self.table).alias("table"), "breach", "rows")

    def check(self, df: DataFrame, lengths: bool = False) -> None:
        """Audit a table: count the breaches of every rule, then look for repeated keys."""
        counts = [
            F.count_if(~F.coalesce(condition, F.lit(True))).alias(label)
            for label, (_, condition) in self._conditions(lengths).items()
        ]
        found = df.agg(*counts).first().asDict() if counts else {}
        broken = {label: n for label, n in found.items() if n}
        if self.key:
            repeated = df.groupBy(*self.key).count().filter("count > 1").count()
            broken |= {"key is repeated": repeated} if repeated else {}
        if broken:
            raise ContractViolation(f"{self.table}: {broken}")


# Fixed values from here on: the stored tables. Counts are bigint because a merchant-day
# may exceed the range of int.
_MERCHANT_DAY = {"merchant_id": "string", "transaction_date": "date"}
_ID_LENGTHS = {"merchant_id": 50}

PROCESSED = Contract(
    "processed_transactions",
    {
        "transaction_id": "string",
        "merchant_id": "string",
        "card_number_masked": "string",
        "amount": "decimal(15,2)",
        "currency": "string",
        "timestamp": "timestamp",
        "customer_id_hash": "string",
        "location": "string",
        "transaction_date": "date",
        "transaction_hour": "int",
        "completeness_score": "decimal(3,2)",
        "transaction_hash": "string",
        "created_at": "timestamp",
    },
    key=("transaction_id",),
    not_null=("merchant_id", "amount", "currency", "timestamp", "transaction_date"),
    lengths={"transaction_id": 50, "merchant_id": 50, "currency": 3, "location": 100},
    cluster_by=("merchant_id",),
    find_by=("transaction_id",),
)

INVALID = Contract(
    "invalid_transactions",
    {
        "transaction_id": "string",
        "merchant_id": "string",
        "card_number_masked": "string",
        "amount": "double",
        "currency": "string",
        "timestamp": "timestamp",
        "customer_id": "string",
        "location": "string",
        "transaction_date": "date",
        "validation_errors": "array<string>",
        "created_at": "timestamp",
    },
    not_null=("validation_errors",),
    lengths={"transaction_id": 50, "merchant_id": 50, "currency": 3, "customer_id": 50, "location": 100},
)

DAILY_MERCHANT_SUMMARY = Contract(
    "daily_merchant_summary",
    {
        **_MERCHANT_DAY,
        "total_transactions": "bigint",
        "total_amount": "decimal(15,2)",
        "avg_transaction_amount": "decimal(10,2)",
        "min_transaction_amount": "decimal(10,2)",
        "max_transaction_amount": "decimal(10,2)",
        "std_transaction_amount": "decimal(10,2)",
        "total_customers": "bigint",
        "currencies_used": "array<string>",
        "locations": "array<string>",
        "active_hours": "array<string>",
        "currency_count": "int",
        "location_count": "int",
        "active_hour_count": "int",
        "avg_data_quality_score": "decimal(3,2)",
        "first_transaction_time": "timestamp",
        "last_transaction_time": "timestamp",
        "summary_generated_at": "timestamp",
    },
    key=("merchant_id", "transaction_date"),
    not_null=("total_transactions", "total_amount"),
    lengths=_ID_LENGTHS,
    cluster_by=("merchant_id",),
)

RISK_METRICS = Contract(
    "risk_metrics",
    {
        **_MERCHANT_DAY,
        "high_value_transactions": "bigint",
        "very_high_value_transactions": "bigint",
        "transaction_velocity": "bigint",
        "max_single_transaction": "decimal(15,2)",
        "max_transaction_ratio": "decimal(5,4)",
        "unique_locations": "bigint",
        "unique_customers": "bigint",
        "risk_score": "int",
        "risk_level": "string",
    },
    key=("merchant_id", "transaction_date"),
    checks={"risk level is unknown": ("risk_level", "risk_level IN ('LOW', 'MEDIUM', 'HIGH')")},
    lengths={**_ID_LENGTHS, "risk_level": 10},
    cluster_by=("merchant_id",),
)

HOURLY_PATTERNS = Contract(
    "hourly_patterns",
    {
        **_MERCHANT_DAY,
        "transaction_hour": "int",
        "hourly_transactions": "bigint",
        "hourly_amount": "decimal(15,2)",
        "hourly_avg_amount": "decimal(10,2)",
    },
    key=("merchant_id", "transaction_date", "transaction_hour"),
    checks={"hour is outside 0-23": ("transaction_hour", "transaction_hour BETWEEN 0 AND 23")},
    lengths=_ID_LENGTHS,
    cluster_by=("merchant_id",),
)

CURRENCY_BREAKDOWN = Contract(
    "currency_breakdown",
    {
        **_MERCHANT_DAY,
        "currency": "string",
        "currency_transactions": "bigint",
        "currency_amount": "decimal(15,2)",
        "currency_avg_amount": "decimal(10,2)",
    },
    key=("merchant_id", "transaction_date", "currency"),
    lengths={**_ID_LENGTHS, "currency": 3},
    cluster_by=("merchant_id",),
)

MERCHANT_KPIS = Contract(
    "merchant_kpis",
    {
        **_MERCHANT_DAY,
        "transaction_count": "bigint",
        "gross_volume": "decimal(15,2)",
        "average_ticket_size": "decimal(10,2)",
        "revenue_per_transaction": "decimal(10,2)",
        "customer_count": "bigint",
        "revenue_per_customer": "decimal(10,2)",
        "active_locations": "int",
        "operating_hours": "int",
        "data_quality_score": "decimal(3,2)",
    },
    key=("merchant_id", "transaction_date"),
    lengths=_ID_LENGTHS,
    cluster_by=("merchant_id",),
)

QUALITY_REPORTS = Contract(
    "data_quality_reports",
    {
        "processing_date": "date",
        "raw_transactions": "bigint",
        "valid_transactions": "bigint",
        "invalid_transactions": "bigint",
        "total_transactions": "bigint",
        "data_quality_percentage": "decimal(5,2)",
        "pct_of_raw": "decimal(5,2)",
        "processing_duration_seconds": "bigint",
        "errors_encountered": "string",
        "created_at": "timestamp",
    },
    key=("processing_date",),
    not_null=("valid_transactions", "invalid_transactions", "total_transactions", "data_quality_percentage"),
    checks={
        "percentage is outside 0-100": ("data_quality_percentage", "data_quality_percentage BETWEEN 0 AND 100")
    },
)

RUN_STATUSES = ("RUNNING", "SUCCESS", "FAILED", "PARTIAL")

RUN_LOG = Contract(
    "pipeline_processing_logs",
    {
        "run_id": "string",
        "processing_date": "date",
        "pipeline_mode": "string",
        "start_time": "timestamp",
        "end_time": "timestamp",
        "status": "string",
        "records_processed": "bigint",
        "records_valid": "bigint",
        "records_invalid": "bigint",
        "error_message": "string",
        "processing_duration_seconds": "bigint",
        "created_at": "timestamp",
    },
    key=("run_id",),
    not_null=("processing_date", "pipeline_mode", "start_time", "status"),
    checks={"status is unknown": ("status", f"status IN {RUN_STATUSES}")},
    lengths={"pipeline_mode": 20, "status": 20},
)

SUMMARY_CONTRACTS = {
    c.table: c
    for c in (DAILY_MERCHANT_SUMMARY, RISK_METRICS, HOURLY_PATTERNS, CURRENCY_BREAKDOWN, MERCHANT_KPIS)
}


def contract_audit(tables: dict[Contract, DataFrame], lengths: bool = False) -> DataFrame:
    """All breaches of all ``tables`` in one frame; a stored table is audited over all its partitions."""
    found = reduce(DataFrame.unionByName, [contract.breaches(frame, lengths) for contract, frame in tables.items()])
    return found.where("rows > 0")
