"""Which windows of a text also occur elsewhere: names for units of windows, refined step by step.

A unit is a stretch of consecutive window starts with two names: ``core`` for the symbols that all
its windows share and ``full`` for everything they cover. Equal windows lie at equal places of
units with equal cores. So units whose core is unique are dropped; units that share both names, 128
bits over symbols drawn for the run, are repeated throughout; only where one core goes with several full names is it open which windows
are repeated, and then one unit of each full name is cut into smaller ones and ranked again, down
to single windows. All counting, joining and ranking of names is done by Spark; tasks only compute
the names of the text in front of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import drop_staged, staged
from tallyhouse.llm.rolling import Rolling, covered, mix

_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
CHUNK_ROWS = 1 << 16


@dataclass
class Words:
    """Hash, first and last byte of every word of a text."""

    symbols: np.ndarray
    first: np.ndarray
    last: np.ndarray


LONG_WORD = 64


class Symbols:
    """Numbers for bytes and words, drawn from a key.

    With a key of its own for each run, nobody can prepare texts that share a fingerprint. The numbers
    of any two bytes differ in their low 16 bits, so sequences of up to 300 bytes cannot cancel out
    as Thue and Morse's do; longer words go by a keyed hash of their bytes.
    """

    def __init__(self, key: bytes | None = None):
        self.key, self.bytes = key, _BYTE
        draw = 0
        while key is not None and (draw == 0 or len(np.unique(self.bytes & np.uint64(0xFFFF))) < 256):
            blocks = [hashlib.blake2b(bytes([draw % 256, i]), key=key).digest() for i in range(32)]
            self.bytes, draw = np.frombuffer(b"".join(blocks), np.uint64), draw + 1

    def of_bytes(self, text: bytes) -> np.ndarray:
        return self.bytes[np.frombuffer(text, np.uint8)]

    def of_words(self, text: bytes, separators: np.ndarray = _SPACE) -> Words:
        """Words are runs of bytes that are not ``separators``, by default ASCII white space."""
        octets = np.frombuffer(text, np.uint8)
        inside = np.concatenate(([False], ~separators[octets], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[::2], edges[1::2]
        length = last - first
        symbols = mix(Rolling(self.bytes[octets]).of(first, length) + mix(length.astype(np.uint64)))
        if self.key is not None:
            for i in np.flatnonzero(length > LONG_WORD).tolist():
                digest = hashlib.blake2b(text[first[i] : last[i]], digest_size=8, key=self.key).digest()
                symbols[i] = int.from_bytes(digest, "little")
        return Words(symbols, first, last)


_FIXED = Symbols()
word_symbols = _FIXED.of_words


def documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, text): a row is known by its id and a hash of its text; a null text is empty."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def longs(*columns: np.ndarray) -> list[pa.Array]:
    return [pa.array(c.astype(np.uint64).view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in columns]


def per_document(batches, compute: Callable, names: list[str], carry: list[str]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of what ``compute`` makes of each row: arrays of equal length, the row's ``carry`` repeated."""
    parts, rows = [], 0

    def flush(schema):
        columns = [np.concatenate(c) for c in zip(*(p[1] for p in parts), strict=True)]
        sizes = [len(p[1][0]) for p in parts]
        taken = [
            pa.array([p[0][i] for p in parts], schema.field(name).type).take(pa.array(np.repeat(np.arange(len(parts)), sizes)))
            for i, name in enumerate(carry)
        ]
        return pa.RecordBatch.from_arrays([*taken, *longs(*columns)], [*carry, *names])

    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            made = compute(row)
            if made is not None and len(made[0]):
                parts.append(([row[name] for name in carry], made))
                rows += len(made[0])
            if rows >= CHUNK_ROWS:
                yield flush(batch.schema)
                parts, rows = [], 0
        if parts:
            yield flush(batch.schema)
            parts, rows = [], 0


UNIT = ["core", "full", "start", "count", "shift"]


@dataclass
class Repeats:
    """How units of one kind of text are read, refined and judged.

    ``cut`` takes stretches (start, length) of symbols out of a text, as bytes; ``symbols`` makes
    symbol hashes of such bytes, one of every ``symbol_bytes``. ``sizes`` are the lengths of smaller units, ending with 1. With
    ``earlier`` a window is repeated if a row of a smaller id has it, else if it starts anywhere else.
    """

    window: int
    cut: Callable[[bytes, np.ndarray, np.ndarray], list[bytes]]
    symbols: Callable[[bytes], np.ndarray]
    sizes: tuple[int, ...] = (10, 1)
    earlier: bool = False
    symbol_bytes: int = 1

    def repeated(self, units: DataFrame, docs: DataFrame) -> DataFrame:
        """(id, h, start, count) of repeated windows, from staged ``units`` (id, h and the columns of a unit)."""
        judged, open_classes = self._judge(units, ["h"])
        content = staged(self._contents(docs, open_classes), "unit-contents")
        return self._refine(judged, ["id", "h"], content, self.sizes)

    def _judge(self, units: DataFrame, owner: list[str]) -> tuple[DataFrame, DataFrame]:
        """Units that are repeated throughout or open, and one unit of each full name under mixed cores."""
        # Aggregates are staged before they are joined: between two plain shuffles Spark splits a hot core.
        cores = units.groupBy("core").agg(F.count(F.lit(1)).alias("n"), (F.min("full") != F.max("full")).alias("mixed"))
        cores = staged(cores.where("n > 1").drop("n"), "shared-cores")
        live = staged(units.join(cores, "core"), "live-units")
        drop_staged(units)
        drop_staged(cores)
        first = F.min(F.struct("id", *owner, "start", "count", "shift")).alias("first")
        ranks = live.groupBy("core", "full").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.max("mixed").alias("mixed"), first)
        ranks = staged(ranks, "unit-classes")
        whole = F.coalesce(F.col("least") < F.col("id"), F.lit(False)) if self.earlier else F.col("n") > 1
        judged = live.drop("shift", "mixed").join(ranks.drop("first"), ["core", "full"]).withColumn("whole", whole)
        judged = staged(judged.where("whole OR mixed").drop("core", "n", "least", "mixed"), "judged-units")
        drop_staged(live)
        return judged, ranks.where("mixed").select("full", "first.*")

    def _refine(self, judged: DataFrame, keys: list[str], content: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
        whole = judged.where("whole").select(*keys, "start", "count")
        if not sizes:
            return whole
        units = staged(self._smaller(content, sizes[0]), "small-units")
        small, open_classes = self._judge(units, ["owner"])
        inner = open_classes.select("full", "owner", "start", "count", "shift", F.col("id").alias("first_id"))
        held = content.select(F.col("full").alias("owner"), F.col("start").alias("base"), "content")
        following = inner.join(held, "owner").select("full", F.col("first_id").alias("id"), "start", "count", "shift", "base", "content")
        inside = self._refine(small, ["owner"], following, sizes[1:])
        inside = inside.select(F.col("owner").alias("full"), F.col("start").alias("at"), F.col("count").alias("n"))
        opened = judged.where("NOT whole").join(inside, "full")
        # Starts within a smaller unit count from the start of what its owner covers.
        return whole.union(opened.select(*keys, (F.col("start") + F.col("at")).alias("start"), F.col("n").alias("count")))

    def _contents(self, docs: DataFrame, open_classes: DataFrame) -> DataFrame:
        """What one unit of every open class covers: (full, id, start 0, count, shift, base 0, content)."""
        unit = F.struct("full", "start", "count", "shift")
        wanted = open_classes.groupBy("id", "h").agg(F.collect_list(unit).alias("units"))
        wanted = wanted.select(F.col("id").alias("wanted_id"), F.col("h").alias("wanted_h"), "units")
        same = docs["id"].eqNullSafe(wanted["wanted_id"]) & (docs["h"] == wanted["wanted_h"])
        source = docs.join(wanted, same).select("id", "text", "units")

        def compute(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    units = batch.column("units")[i].values
                    full, start, count, shift = (units.field(k) for k in range(4))
                    lengths = count.to_numpy() + (self.window - 1)
                    found = self.cut(batch.column("text")[i].as_py(), start.to_numpy(), lengths)
                    ids = pa.array([batch.column("id")[i].as_py()] * len(found), batch.schema.field("id").type)
                    zero = pa.array(np.zeros(len(found), np.int64))
                    columns = [full, ids, zero, count, shift, zero, pa.array(found, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["full", "id", "start", "count", "shift", "base", "content"])

        kind = source.schema["id"].dataType.simpleString()
        schema = f"full long, id {kind}, start long, count long, shift long, base long, content binary"
        # A repeated row gives the same content again.
        return source.mapInArrow(compute, schema).dropDuplicates(["full"])

    def _smaller(self, content: DataFrame, size: int) -> DataFrame:
        """The units of ``size`` starts within each stretch ``start, count`` of a content.

        Units are cut at multiples of ``size`` from the anchor, which is at the same place wherever
        the core is the same. ``core`` covers the whole multiple even if the unit has part of it.
        """
        window, names = self.window, ["owner", "id", *UNIT]

        def compute(batches):
            for batch in batches:
                # All contents of a batch in a row: fingerprints do not depend on the place.
                pieces = batch.column("content").to_pylist()
                rolling = Rolling(self.symbols(b"".join(pieces)))
                sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // self.symbol_bytes
                base = np.cumsum(sizes) - sizes
                lo, n, shift = (batch.column(c).to_numpy() for c in ("start", "count", "shift"))
                anchor = lo + shift
                first = lo - (lo - anchor) % size
                parts = -((first - lo - n) // size)
                row = np.repeat(np.arange(len(pieces)), parts)
                edges = first[row] + size * (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts))
                start = np.maximum(edges, lo[row])
                count = np.minimum(edges + size, (lo + n)[row]) - start
                apart = anchor[row] - start
                place = mix((edges - anchor[row] + (1 << 24)).astype(np.uint64))
                core = mix(rolling.of(base[row] + edges + (size - 1), window - size + 1) + place)
                full = covered(rolling, base[row] + start, count, apart, window)
                carried = [batch.column(c).take(pa.array(row)) for c in ("owner", "id")]
                yield pa.RecordBatch.from_arrays([*carried, *longs(core, full, start - lo[row], count, apart)], names)

        kind = content.schema["id"].dataType.simpleString()
        schema = f"owner long, id {kind}, core long, full long, start long, count long, shift long"
        return content.withColumnRenamed("full", "owner").mapInArrow(compute, schema)


def with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """(id, text, ranges): every row with the repeated stretches found for it, null if none."""
    ranges = ranges.groupBy("id", "h").agg(F.collect_list(F.struct("start", "count")).alias("ranges"))
    ranges = ranges.select(F.col("id").alias("ranges_id"), F.col("h").alias("ranges_h"), "ranges")
    same = docs["id"].eqNullSafe(ranges["ranges_id"]) & (docs["h"] == ranges["ranges_h"])
    return docs.join(ranges, same, "left").select("id", "text", "ranges")


def marked(ranges: pa.ListScalar, size: int, window: int) -> np.ndarray:
    """Which of ``size`` symbols the windows of ``ranges`` cover."""
    change = np.zeros(size + 1, np.int64)
    if ranges.is_valid:
        start, count = (ranges.values.field(k).to_numpy() for k in (0, 1))
        np.add.at(change, start, 1)
        np.add.at(change, start + count + (window - 1), -1)
    return np.cumsum(change[:-1]) > 0
