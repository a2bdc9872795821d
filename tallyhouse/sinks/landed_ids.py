"""Which ids have landed on earlier days: exact, and without reading what cannot hold a repeat.

Every landed day leaves its ids and a Bloom filter over them. The filter is a set of blocks of 32,768
bits; an id belongs to one block and sets six bits there, so a probe is a join on the block number.
It leaves pairs (id, day) that may be repeats: all real ones and about one in a hundred of the
others. Only days that occur in a pair have their ids read, and an exact join decides. What is read
thus follows the repeats that there are, not the length of the history.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sinks import files
from tallyhouse.sinks.files import DAY

BLOCK_BITS = 32768  # the size of Spark's own bitmaps
BITS_PER_ID = 10
PROBES = 6


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _positions(key: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(1, PROBES + 1)])


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bits, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


@dataclass(frozen=True)
class LandedIds:
    """The ids of landed days below ``root``, in folders ``ids`` and ``filters`` by day."""

    root: str
    key: str = "transaction_id"

    def _path(self, kind: str) -> str:
        return f"{self.root.rstrip('/')}/{kind}"

    def record(self, df: DataFrame, day: dt.date | str) -> None:
        """Make the ids of ``df`` those of ``day``. The filter is written last: a day without one has not landed."""
        spark = df.sparkSession
        files.drop_path(spark, f"{self._path('filters')}/{DAY}={day}")
        stored = f"{self._path('ids')}/{DAY}={day}"
        df.select(self.key).where(F.col(self.key).isNotNull()).distinct().write.mode("overwrite").parquet(stored)
        ids = spark.read.parquet(stored)
        wanted = max(1, -(-ids.count() * BITS_PER_ID // BLOCK_BITS))
        blocks = 1 << (wanted - 1).bit_length()  # a power of two, so that days share few sizes
        key = F.col(self.key)
        bits = ids.select(_block(key, F.lit(blocks)).alias("block"), F.explode(_positions(key)).alias("position"))
        filters = bits.groupBy("block").agg(F.bitmap_construct_agg("position").alias("bits"))
        filters = filters.select(F.lit(blocks).cast("long").alias("blocks"), "block", "bits")
        filters.write.mode("overwrite").parquet(f"{self._path('filters')}/{DAY}={day}")

    def _filters(self, spark: SparkSession, before: dt.date | str) -> DataFrame | None:
        schema = f"blocks long, block long, bits binary, {DAY} date"
        try:
            stored = spark.read.schema(schema).parquet(self._path("filters"))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return stored.where(F.col(DAY) < F.lit(str(before)).cast("date"))

    def candidates(self, df: DataFrame, day: dt.date | str) -> DataFrame | None:
        """(key, date): ids of ``df`` and the days before ``day`` whose filters have them; None without such days."""
        filters = self._filters(df.sparkSession, day)
        sizes = [r.blocks for r in filters.select("blocks").distinct().collect()] if filters is not None else []
        if not sizes:
            return None
        days = filters.groupBy("blocks", "block").agg(F.collect_list(F.struct(DAY, "bits")).alias("days"))
        key = F.col(self.key)
        ids = df.select(key).where(key.isNotNull()).distinct()
        probes = ids.withColumn("blocks", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])))
        probes = probes.withColumn("block", _block(key, F.col("blocks"))).withColumn("positions", _positions(key))
        may_hold = F.filter("days", lambda d: F.forall("positions", lambda p: _is_set(d["bits"], p)))
        found = probes.join(days, ["blocks", "block"]).select(self.key, F.explode(may_hold).alias("day"))
        return found.select(self.key, f"day.{DAY}")

    def repeats(self, df: DataFrame, day: dt.date | str) -> DataFrame | None:
        """The ids of ``df`` that landed before ``day``; only days with a candidate are read."""
        spark = df.sparkSession
        found = self.candidates(df, day)
        if found is None:
            return None
        found, _ = files.stage(found, "landed-candidates")
        hit = sorted(str(r[DAY]) for r in found.select(DAY).distinct().collect())
        if not hit:
            return None
        base = self._path("ids")
        landed = spark.read.option("basePath", base).parquet(*[f"{base}/{DAY}={d}" for d in hit])
        landed = landed.withColumn(DAY, F.col(DAY).cast("date"))
        return landed.join(found, [self.key, DAY], "left_semi").select(self.key).distinct()

    def unseen(self, df: DataFrame, day: dt.date | str) -> DataFrame:
        """The rows of ``df`` whose id has not landed before ``day``; rows without an id stay."""
        repeats = self.repeats(df, day)
        if repeats is None:
            return df
        repeats, _ = files.stage(repeats, "landed-repeats")
        return df.join(repeats, self.key, "left_anti")
