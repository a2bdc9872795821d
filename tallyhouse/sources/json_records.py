"""Records of JSON documents of any layout, many tasks to a file.

A multi-line reader needs the whole file in one task. Here a file is cut at every closing brace, so
Spark splits it like any text. Where a record starts can be told from the piece alone: its first
brace follows nothing but brackets, commas and white space and opens a name. Inside a string that
cannot occur, since a quote there would be escaped, nor can it after a nested object. Every other
piece that is not blank goes on with the record before it: after a brace within a string, after a
nested object, or in a broken place. Such pieces are rare, and only the files that have any are
put together: the last record start before each piece is found within its split first, then over
the splits of the file. So no file is ever one task, and a broken record spoils nothing but itself.

Limits: the elements of an array inside a record would count as records, if they are objects with
fields; a record without any field is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STARTS = r'^[\s\x{FEFF},\[]*\{\s*"[^,}\]:\s]'
BLANK = r"^[\s\x{FEFF},\[\]]*$"
BEFORE_START = r"^[\s\x{FEFF},\[]*"
_HOME = ["_file", "_split"]


def _pieces(spark: SparkSession, path: str | list[str], base_path: str | None) -> DataFrame:
    """What lies between closing braces, with its file, the start of its split and its row there."""
    reader = spark.read.option("lineSep", "}")
    if base_path:
        reader = reader.option("basePath", base_path)
    pieces = reader.text(path)
    return pieces.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_split": F.col("_metadata.file_block_start"),
            "_size": F.col("_metadata.file_size"),
            "_row": F.monotonically_increasing_id(),
            "_starts": F.col("value").rlike(STARTS),
            "_blank": F.col("value").rlike(BLANK),
        }
    )


def _closed(text: Column) -> Column:
    return F.concat(text, F.lit("}"))


def irregular_files(pieces: DataFrame) -> DataFrame:
    """(_file, _cut): files in which a record has several pieces, or whose last record is cut short.

    All pieces and their braces are one byte longer than a file that does not end with a brace.
    """
    place = F.struct("_split", "_row")
    found = pieces.groupBy("_file").agg(
        F.bool_or(~F.col("_starts") & ~F.col("_blank")).alias("_goes_on"),
        F.sum(F.octet_length("value") + 1).alias("_bytes"),
        F.max("_size").alias("_size"),
        F.max(F.struct(place, ~F.col("_blank"))).alias("_last"),
    )
    cut = (F.col("_bytes") == F.col("_size") + 1) & F.col("_last.col2")
    return found.select("_file", cut.alias("_cut"), (F.col("_goes_on") | cut).alias("_odd")).where("_odd").drop("_odd")


def _joined(pieces: DataFrame, odd: DataFrame, carried: list[str]) -> DataFrame:
    """The records of irregular files, from all their pieces."""
    start = F.struct("_split", "_row")
    rows = pieces.join(odd, "_file").where("NOT _blank OR value = ''")
    within = Window.partitionBy(*_HOME).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_record", F.last(F.when(F.col("_starts"), start), ignorenulls=True).over(within))
    # What goes on at the beginning of a split belongs to the last record of those before it.
    ends = rows.groupBy(*_HOME).agg(F.max("_record").alias("_ends"))
    before = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_open", F.last("_ends", ignorenulls=True).over(before)).drop("_ends")
    rows = rows.join(ends, _HOME).withColumn("_record", F.coalesce("_record", "_open"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_split", "_row", "value"))), lambda p: p["value"]), "}")
    records = rows.groupBy("_file", "_record", "_cut", *carried).agg(text.alias("_text"))
    # Only the last record of a file that is cut short has no brace of its own.
    last = F.max("_record").over(Window.partitionBy("_file"))
    records = records.withColumn("_short", F.col("_cut") & F.col("_record").eqNullSafe(last))
    return records.select(F.when(F.col("_short"), F.col("_text")).otherwise(_closed(F.col("_text"))).alias("record"), *carried)


def json_records(
    spark: SparkSession, path: str | list[str], base_path: str | None = None, file_col: str | None = None
) -> DataFrame:
    """(record, partition columns …): the text of every record, of broken ones whatever is there.

    ``file_col`` adds the file of each record.
    """
    pieces = _pieces(spark, path, base_path)
    if file_col:
        pieces = pieces.withColumn(file_col, F.col("_file"))
    carried = [c for c in pieces.columns if c != "value" and not c.startswith("_")]
    odd = irregular_files(pieces)
    clean = pieces.where("_starts")
    whole = _closed(F.regexp_replace("value", BEFORE_START, "")).alias("record")
    if odd.isEmpty():
        return clean.select(whole, *carried)
    regular = clean.join(odd, "_file", "left_anti").select(whole, *carried)
    rest = _joined(pieces, odd, carried)
    return regular.unionByName(rest.withColumn("record", F.regexp_replace("record", BEFORE_START, "")))
