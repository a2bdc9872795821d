"""Helpers shared by the text operators: staging, settings, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sinks import files

# Shuffle files go as soon as the action that made them has ended; every staged table is
# complete by then, so nothing reads them again.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Set session options (``__`` stands for a dot) and restore them afterwards."""
    wanted = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder, drop its shuffle files and read it back.

    This is where lineage is cut: a lost executor costs a re-read of files.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        return files.stage(df, name)[0]
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)


def drop_staged(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        files.drop_path(df.sparkSession, folder)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each, over undirected edges (a, b).

    Alternating star contraction: every round hangs each node's larger neighbours, then its
    smaller ones, on its smallest neighbour, until nothing changes. Each round is a grouping
    and a join on node; the smallest neighbour is a map-side minimum, so a node with very many
    neighbours does not gather them. ``nodes`` has one column ``node``.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not links.isEmpty():
        mutual = both(links)
        least = mutual.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = mutual.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a")
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        small = staged(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        same = small.count() == links.count() and small.exceptAll(links).isEmpty()
        drop_staged(links)
        drop_staged(large)
        links = small
        if same:
            break
    least = links.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
    return nodes.join(least, "node", "left").select("node", F.coalesce("m", "node").alias("component"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with a number that makes it none of the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(len(taken) + 1))) if n.lower() not in taken)


def texts(batch, id_name: str = "id", text_name: str = "text") -> Iterator[tuple]:
    """(id, text as bytes) of an Arrow batch, one at a time; a null text is empty."""
    for key, text in zip(batch.column(id_name), batch.column(text_name), strict=True):
        yield key.as_py(), text.as_py() or b""


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns a text operator reads, the text as UTF-8 bytes."""
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))


def fold(id_col: Column, folds: int) -> Column:
    """The fold of a row: CRC-32 of its id as text, modulo ``folds``; 0 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds, F.lit(0))
