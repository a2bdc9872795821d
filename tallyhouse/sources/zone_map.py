"""A zone map of landed files: the days of the times in each, so that late records are found and all
other files are skipped.

Folder dates say when a record landed, not when it happened. The map is written at landing, by one
pass over the new files; a range then reads exactly the files with a record on one of its days. The
days are kept one by one: between its least and greatest time a file with one late record would
seem to hold weeks. Files that
the map does not know yet are read as well, so a map that lags behind costs time, not records.
"""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.transactions import filter_date_range, read_transactions

FILE = "file"


def write_zone_map(
    spark: SparkSession, root: str, map_path: str, multi_line: bool = True, landed: list[str] | None = None
) -> None:
    """Map all files below ``root``, or add those of the ``landed`` folders to the map."""
    rows = read_transactions(spark, landed or root, multi_line, base_path=root, file_col=FILE)
    zones = rows.groupBy(FILE).agg(F.collect_set(F.col("timestamp").cast("date")).alias("days"), F.count(F.lit(1)).alias("rows"))
    zones.write.mode("append" if landed else "overwrite").parquet(map_path)


def _name(uri: str) -> str:
    """One spelling of a file's name: Spark writes local ones with one slash or three, escaped."""
    return re.sub("^file:/+", "file:///", unquote(uri))


def files_in_range(spark: SparkSession, root: str, map_path: str, start: dt.date | str, end: dt.date | str) -> list[str]:
    """Files that may hold times of the range: as the map has it, and those it does not know.

    The driver sees names of files, as it does whenever Spark lists a folder.
    """
    listed = {_name(name) for name in spark.read.text(root).inputFiles()}
    try:
        zones = spark.read.parquet(map_path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return sorted(listed)
        raise
    first, last = (F.lit(str(day)).cast("date") for day in (start, end))
    inside = F.exists("days", lambda day: day.between(first, last))
    known, hit = set(), set()
    for row in zones.groupBy(FILE).agg(F.bool_or(inside).alias("hit")).toLocalIterator():
        name = _name(row[FILE])
        known.add(name)
        if row.hit:
            hit.add(name)
    return sorted((hit & listed) | (listed - known))


def read_mapped_range(
    spark: SparkSession, root: str, map_path: str, start: dt.date | str, end: dt.date | str, multi_line: bool = True
) -> DataFrame:
    """Transactions whose timestamp lies in the range, end day included, however late they landed."""
    wanted = files_in_range(spark, root, map_path, start, end)
    if not wanted:  # nothing in range: the schema of the whole, without rows
        return read_transactions(spark, root, multi_line=False).where(F.lit(False))
    return filter_date_range(read_transactions(spark, wanted, multi_line, base_path=root), start, end)
