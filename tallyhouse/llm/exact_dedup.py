"""Exact deduplication with a streaming keyed state.

A file stream of (digest, id, row, locator) runs through a grouping whose state lies in RocksDB
on the executors' disks, checkpointed to the shared folder, without a watermark: a digest seen
once is remembered for good. The state of a digest holds the row that stays (largest id), where
its text lies, and the number of rows. Digests seen more than once are hits; their full texts are
compared, and rows whose texts differ under one digest are grouped again by the text itself.

Defined results: a null text counts as empty; of rows with the same id and text one stays; a row
without an id stays only where no row of its group has one. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.llm.common import free_name, settings, staged
from tallyhouse.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SETTINGS = {
    "spark__sql__streaming__stateStore__providerClass": ROCKSDB,
    # One bounded cache per executor instead of one per state partition.
    "spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage": "true",
    "spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB": "256",
    "spark__sql__streaming__stateStore__rocksdb__writeBufferSizeMB": "4",
    # Otherwise every state partition sets several MB of disk aside for its logs.
    "spark__sql__streaming__stateStore__rocksdb__allowFAllocate": "false",
}
SALTS = 16


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def arrivals(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """What the stream sees of a row: its digest, id, a row number and the file its text lies in."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        digest(text).alias("digest"),
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.input_file_name().alias("locator"),
    )


def start_dedup_stream(stream: DataFrame, checkpoint: str) -> StreamingQuery:
    """Fold a stream of arrivals into the state at ``checkpoint``; restart with the same folder to go on."""
    state = stream.groupBy("digest").agg(
        F.max(F.struct("id", "row", "locator")).alias("stays"), F.count(F.lit(1)).alias("size")
    )
    writer = state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
    with settings(stream.sparkSession, **STATE_SETTINGS):
        return writer.option("checkpointLocation", checkpoint).start()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per digest ever seen: (digest, id, row, locator, size)."""
    with settings(spark, **STATE_SETTINGS):
        state = spark.read.format("statestore").load(checkpoint).select("key.*", "value.*")
    digest, stays, size = state.columns
    return state.select(
        F.col(digest).alias("digest"),
        *[F.col(f"`{stays}`.{field}").alias(field) for field in ("id", "row", "locator")],
        F.col(size).alias("size"),
    )


def colliding_digests(docs: DataFrame, state: DataFrame, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests that stand for more than one text: the full texts of all hits are compared.

    A digest with very many rows is spread over salts, and equal texts meet within a salt first.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hits = state.where("size > 1").select("digest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = docs.select(digest(text).alias("digest"), text.alias("text"))
    rows = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    texts = rows.join(hits, ["digest", "salt"], "left_semi").groupBy("digest", "salt", "text").agg(F.count(F.lit(1)))
    return texts.select("digest", "text").distinct().groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256_digest,
) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) for every row of ``docs``."""
    spark = docs.sparkSession
    seen = staged(arrivals(docs, id_col, text_col, digest), "arrivals")
    checkpoint = scratch_path(spark, "dedup-state")
    # The folder's files are the stream; a running service would watch a landing folder instead.
    files = seen.inputFiles()
    folder = files[0].rpartition("/")[0] if files else None
    if folder is None:
        state = seen.groupBy("digest").agg(F.max("id").alias("id"), F.max("row").alias("row"), F.max("locator").alias("locator"), F.count(F.lit(1)).alias("size"))
    else:
        start_dedup_stream(spark.readStream.schema(seen.schema).parquet(folder), checkpoint).awaitTermination()
        state = read_state(spark, checkpoint)
    state = staged(state, "dedup-classes")
    collided = staged(colliding_digests(docs, state, text_col, digest).select("digest"), "collided")
    stays = state.select("digest", F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("size").alias("group_size"))
    output = ["id", "keep_id", "group_size", F.expr("row = keep_row").alias("kept"), "digest"]
    if collided.isEmpty():
        return seen.join(stays, "digest").select(*output)
    plain = seen.join(collided, "digest", "left_anti").join(stays, "digest").select(*output)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rest = docs.select(digest(text).alias("digest"), F.col(id_col).alias("id"), text.alias("text"))
    rest = staged(rest.join(collided, "digest", "left_semi").withColumn("row", F.monotonically_increasing_id()), "collided-rows")
    groups = rest.groupBy("digest", "text").agg(F.max(F.struct("id", "row")).alias("stays"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select("digest", "text", F.col("stays.id").alias("keep_id"), F.col("stays.row").alias("keep_row"), "group_size")
    return plain.union(rest.join(groups, ["digest", "text"]).select(*output))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key, mark = free_name(docs, "_id"), free_name(docs, "_digest")
    rows = exact_dedup(docs, id_col, text_col).groupBy("id", "digest").agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    rows = staged(rows.where("kept").select(F.col("id").alias(key), F.col("digest").alias(mark), "n"), "kept-rows")
    text = F.coalesce(F.col(text_col), F.lit(""))
    same = F.col(id_col).eqNullSafe(F.col(key)) & (sha256_digest(text) == F.col(mark))
    once = docs.join(rows.where("n = 1").drop("n"), same, "left_semi")
    # Rows that are repeated with their id: one of them.
    repeated = rows.where("n > 1").drop("n")
    if repeated.isEmpty():
        return once
    return once.union(docs.join(repeated, same, "left_semi").dropDuplicates([id_col, text_col]))
