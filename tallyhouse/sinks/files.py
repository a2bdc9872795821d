"""File sinks: Parquet and JSON, with partition-wise replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schema import TIMESTAMP_FORMAT, WRITTEN_TIMESTAMP_FORMAT
from tallyhouse.session import hadoop_path, scratch_path, sized_shuffles

FORMATS = ("parquet", "json")
DAY = "date"


def _writer(df: DataFrame, mode: str, columns: Sequence[str] | None, rebalance: bool | None) -> DataFrameWriter:
    """``rebalance`` evens out file sizes at the price of one shuffle.

    By default it is done for partitioned writes, where each task would else leave a file in
    every partition: rows of one partition go to few tasks, and AQE splits a large one again.
    """
    if rebalance or (rebalance is None and columns):
        df = df.hint("rebalance", *(columns or ()))
    writer = df.write.mode(mode)
    return writer.option("partitionOverwriteMode", "dynamic").partitionBy(*columns) if columns else writer


def write_parquet(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] | None = None,
    mode: str = "overwrite",
    rebalance: bool | None = None,
) -> None:
    """With ``partition_cols``, an overwrite replaces only the partitions present in ``df``."""
    _writer(df, mode, partition_cols, rebalance).parquet(path)


def write_json(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] | None = None,
    mode: str = "overwrite",
    rebalance: bool | None = None,
) -> None:
    """JSON Lines; times as UTC with microseconds, which the reader accepts like whole seconds."""
    writer = _writer(df, mode, partition_cols, rebalance)
    writer.option("timestampFormat", WRITTEN_TIMESTAMP_FORMAT).option("timeZone", "UTC").json(path)


def _check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}: use one of {FORMATS}")


def replace_days(
    df: DataFrame, table_path: str, fmt: str = "parquet", cluster_by: Sequence[str] = (), find_by: Sequence[str] = ()
) -> None:
    """Replace the ``date`` partitions present in ``df``; the other partitions stay.

    The new files are staged and swapped in when the job commits, so a failed run keeps
    the old partitions. Rows of a file are sorted by ``cluster_by``, so that a look-up skips
    row groups by their least and greatest values; Parquet files have Bloom filters on
    ``find_by``, columns of values too scattered for that.
    """
    _check_format(fmt)
    if cluster_by:
        df = df.hint("rebalance", DAY).sortWithinPartitions(DAY, *cluster_by)
    writer = _writer(df, "overwrite", [DAY], False if cluster_by else None)
    for column in find_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if fmt == "json":
        writer = writer.option("timestampFormat", WRITTEN_TIMESTAMP_FORMAT).option("timeZone", "UTC")
    writer.format(fmt).save(table_path)


def replace_day(
    df: DataFrame,
    table_path: str,
    day: str,
    fmt: str = "parquet",
    empty: bool | None = None,
    cluster_by: Sequence[str] = (),
    find_by: Sequence[str] = (),
) -> None:
    """Make ``df`` the whole content of partition ``date=day``.

    Dynamic overwrite ignores partitions without rows; an empty result is therefore
    written over the folder itself, or a re-run would keep stale rows. Say whether the
    frame is ``empty`` if you know; otherwise one short job finds out.
    """
    _check_format(fmt)
    if df.isEmpty() if empty is None else empty:
        nothing = df.sparkSession.createDataFrame([], df.schema)
        nothing.write.mode("overwrite").format(fmt).save(f"{table_path}/{DAY}={day}")
        return
    replace_days(df.withColumn(DAY, F.lit(day)), table_path, fmt, cluster_by, find_by)


def read_table(
    spark: SparkSession, table_path: str, schema: T.StructType, fmt: str = "parquet", partition: str | None = DAY
) -> DataFrame:
    """A stored table with its contract's schema; an absent table reads as empty."""
    _check_format(fmt)
    full = T.StructType([*schema.fields])
    if partition:
        full.add(partition, T.DateType())
    reader = spark.read.schema(full)
    if fmt == "json":
        reader = reader.option("timestampFormat", TIMESTAMP_FORMAT).option("timeZone", "UTC")
    try:
        return reader.format(fmt).load(table_path).select(*full.names)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], full)
        raise


def stage(df: DataFrame, name: str, partition_cols: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """Write an intermediate table to the shared scratch folder and read it back.

    Everything derived from the result starts at these files: it reads only the columns
    it needs, and a lost executor costs one re-read instead of the job so far.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    with sized_shuffles(df):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this job created, through the file system that holds it."""
    file_system, target = hadoop_path(spark, path)
    file_system.delete(target, True)
