"""Raw transactions from JSON or Parquet, at any URI Hadoop can open."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.json_records import json_records
from tallyhouse.schema import (
    CORRUPT_RECORD,
    IS_CORRUPT,
    TIMESTAMP_FORMAT,
    TRANSACTION_FIELDS,
    TRANSACTION_SCHEMA,
)

OBJECT_STORE = "s3"
LOCAL = "local"
PARTITION_COLUMNS = ["year", "month", "day"]


def read_transactions(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = True,
    base_path: str | None = None,
    file_col: str | None = None,
) -> DataFrame:
    """JSON transactions with the fixed schema and an ``is_corrupt`` flag.

    A field that does not parse becomes NULL. A record that does not parse at all becomes a
    row of NULLs with ``is_corrupt`` set; its raw text is dropped here because it holds card
    numbers. One bad field marks a record's text as corrupt, so the flag asks for all fields
    to be NULL as well.

    Files may hold arrays, single objects or objects in a row; ``json_records`` splits them
    at a check of the text for records that need putting together. Pass ``multi_line=False``
    for JSON Lines, which Spark reads in a single pass. ``file_col`` adds the file of each record.
    """
    schema = T.StructType([*TRANSACTION_SCHEMA.fields, T.StructField(CORRUPT_RECORD, T.StringType())])
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT_RECORD,
        "timestampFormat": TIMESTAMP_FORMAT,
        "timeZone": "UTC",
    }
    if multi_line:
        records = json_records(spark, path, base_path, file_col)
        parsed = records.withColumn("_parsed", F.from_json("record", schema, options))
        raw = parsed.select("_parsed.*", *[c for c in records.columns if c != "record"])
    else:
        reader = spark.read.schema(schema).options(**options)
        if base_path:
            reader = reader.option("basePath", base_path)
        raw = reader.json(path)
        if file_col:
            raw = raw.withColumn(file_col, F.col("_metadata.file_path"))
    nothing_read = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in TRANSACTION_FIELDS])
    return raw.withColumn(IS_CORRUPT, nothing_read & F.col(CORRUPT_RECORD).isNotNull()).drop(CORRUPT_RECORD)


def read_by_date(
    spark: SparkSession,
    root: str,
    year: int | str,
    month: int | str,
    day: int | str,
    mode: str,
    multi_line: bool = True,
) -> DataFrame:
    """One day: ``year=/month=/day=`` folders in ``s3`` mode, ``Y_M_D.json`` in ``local`` mode.

    Only the day's own folder is listed; ``basePath`` still yields the partition columns.
    """
    date = dt.date(int(year), int(month), int(day))
    root = root.rstrip("/")
    if mode == OBJECT_STORE:
        leaf = f"{root}/year={date:%Y}/month={date:%m}/day={date:%d}"
        return read_transactions(spark, leaf, multi_line, base_path=root)
    if mode == LOCAL:
        return read_transactions(spark, f"{root}/{date:%Y_%m_%d}.json", multi_line)
    raise ValueError(f"unknown mode {mode!r}: use {OBJECT_STORE!r} or {LOCAL!r}")


def in_date_range(column: str, start: dt.date | str, end: dt.date | str, data_type: T.DataType) -> Column:
    """From the start of ``start`` to the end of ``end``, as a half-open range.

    Both bounds are literals of the column's own type, so the filter reaches the scan.
    """
    kind = data_type.simpleString()
    first = dt.date.fromisoformat(str(start))
    after = dt.date.fromisoformat(str(end)) + dt.timedelta(days=1)
    return (F.col(column) >= F.lit(str(first)).cast(kind)) & (F.col(column) < F.lit(str(after)).cast(kind))


def filter_date_range(df: DataFrame, start: dt.date | str, end: dt.date | str, column: str = "timestamp") -> DataFrame:
    return df.filter(in_date_range(column, start, end, df.schema[column].dataType))


def landed_between(start: dt.date | str, end: dt.date | str, slack_days: int) -> Column:
    """Condition on the folder date alone, so that whole folders are skipped."""
    slack = dt.timedelta(days=slack_days)
    first = dt.date.fromisoformat(str(start)) - slack
    last = dt.date.fromisoformat(str(end)) + slack
    landed = F.make_date(*PARTITION_COLUMNS)
    return landed.isNull() | landed.between(F.lit(first), F.lit(last))


def read_date_range(
    spark: SparkSession,
    root: str,
    start: dt.date | str,
    end: dt.date | str,
    slack_days: int | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Transactions whose timestamp lies in the range, end day included.

    Every folder is read, since a record may land long after its timestamp. Where that is
    known not to happen, ``slack_days`` skips the folders dated further outside the range;
    folders without a date are still read.
    """
    df = read_transactions(spark, root, multi_line)
    if slack_days is not None and all(c in df.columns for c in PARTITION_COLUMNS):
        df = df.filter(landed_between(start, end, slack_days))
    return filter_date_range(df, start, end)


def data_available(spark: SparkSession, path: str, multi_line: bool = True) -> bool:
    """Whether there is at least one record. Only a missing path counts as "no data"."""
    try:
        return not read_transactions(spark, path, multi_line).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
