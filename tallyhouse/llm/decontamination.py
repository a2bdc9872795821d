"""Benchmark decontamination by greedy string tiling.

A document is contaminated by a test item if tiles, runs of at least five words that both have,
cover a share of the item's words; tiles may lie in any order, so reordered passages are caught.

1. Five-word seeds of the test items are folded into a bitmap of fixed size. Tasks roll over the
   documents and keep only seeds that hit it, so no more than a fraction of a document's seeds
   leaves its task, however large the benchmark.
2. Spark joins these seeds with those of the items. A covered share needs a number of shared seeds
   (a tile of n words has n - 4 of them, at least n / 5); other pairs are dropped.
3. For the pairs that are left the words are tiled: matches are found by Karp-Rabin fingerprints,
   the longest are marked first, and what overlaps a marked tile is shortened and tried again.

Defined results: words are runs of ASCII letters, digits and bytes of other letters, after Unicode
case folding and composition (NFC); null texts have none; an item of fewer than five words must be found in one piece; an item
without words contaminates nothing; repeated rows of a document are reported once.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import staged
from tallyhouse.llm.repeats import documents, longs, per_document, word_symbols
from tallyhouse.llm.rolling import Rolling, mix

FILTER_BITS = 24
_NO_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def folded(text: bytes) -> bytes:
    """The text without differences of case, accented letters composed; bytes that are no UTF-8 stay."""
    if text.isascii():
        return text.lower()
    letters = text.decode(errors="surrogateescape").casefold()
    return unicodedata.normalize("NFC", letters).encode(errors="surrogateescape")


def words(text: bytes) -> np.ndarray:
    return word_symbols(folded(text), _NO_WORD).symbols


def seeds_of(symbols: np.ndarray, length: int) -> np.ndarray:
    return mix(Rolling(symbols).all(length))


def tiles(item: np.ndarray, text: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in text, length), longest first, none overlapping."""
    if min(len(item), len(text)) < shortest:
        return []
    places = defaultdict(list)
    for p, seed in enumerate(seeds_of(item, shortest).tolist()):
        places[seed].append(p)
    grams = seeds_of(text, shortest)
    hits = np.flatnonzero(np.isin(grams, np.array(list(places), np.uint64)))
    running: dict[int, tuple[int, int]] = {}  # diagonal -> (last place in text, first place in text)
    matches = []
    for d in hits.tolist():
        for p in places[int(grams[d])]:
            last, first = running.get(d - p, (-2, d))
            if last != d - 1:
                if last >= 0:
                    matches.append((-(last - first + shortest), first - (d - p), first))
                first = d
            running[d - p] = (d, first)
    matches += [(-(last - first + shortest), first - diagonal, first) for diagonal, (last, first) in running.items()]
    heapq.heapify(matches)
    item_marked, text_marked, marked = np.zeros(len(item), bool), np.zeros(len(text), bool), []
    while matches:
        length, p, d = heapq.heappop(matches)
        taken = item_marked[p : p - length] | text_marked[d : d - length]
        if not taken.any():
            item_marked[p : p - length] = text_marked[d : d - length] = True
            marked.append((p, d, -length))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([True], taken, [True])).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= shortest:
                heapq.heappush(matches, (a - b, p + a, d + a))
    return marked


def _item_seeds(items: DataFrame, seed_words: int) -> DataFrame:
    """(id, h, seed, n): the seeds of an item, of its own length if it is shorter, and its number of words."""

    def compute(row):
        symbols = words(row["text"])
        if not len(symbols):
            return None
        seeds = seeds_of(symbols, min(seed_words, len(symbols)))
        return seeds, np.full(len(seeds), len(symbols))

    kind = items.schema["id"].dataType.simpleString()
    return items.mapInArrow(lambda b: per_document(b, compute, ["seed", "n"], ["id", "h"]), f"id {kind}, h long, seed long, n long")


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Bit ``seed mod 2^FILTER_BITS`` set for every seed; 2 MB at most reach the driver."""
    place = F.col("seed").bitwiseAND((1 << FILTER_BITS) - 1)
    bits = seeds.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, int(seed & 63))").alias("bit"))
    rows = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(1 << FILTER_BITS - 6, np.int64)
    bitmap[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return np.unpackbits(bitmap.view(np.uint8), bitorder="little").view(bool)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = 0.8,
    seed_words: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item_id, n_words, n_covered, n_tiles, longest, coverage) of every contaminated pair."""
    spark = docs.sparkSession
    source = documents(docs, id_col, text_col)
    items = documents(benchmark, item_col, item_text_col)
    item_seeds = staged(_item_seeds(items, seed_words), "benchmark-seeds")
    # Items shorter than a seed have seeds of their own length: few lengths, each rolled once.
    lengths = sorted({min(r["n"], seed_words) for r in item_seeds.select("n").where(F.col("n") < seed_words).distinct().collect()} | {seed_words})
    bitmap = spark.sparkContext.broadcast(np.packbits(_bitmap(item_seeds), bitorder="little"))

    def compute(row):
        symbols = words(row["text"])
        found = np.unique(np.concatenate([seeds_of(symbols, n) for n in lengths]))
        place = found & np.uint64((1 << FILTER_BITS) - 1)
        hit = bitmap.value[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1
        return (found[hit.astype(bool)],)

    kind = source.schema["id"].dataType.simpleString()
    seeds = source.mapInArrow(lambda b: per_document(b, compute, ["seed"], ["id", "h"]), f"id {kind}, h long, seed long")
    wanted = item_seeds.groupBy("seed", F.col("id").alias("item_id"), F.col("h").alias("item_h"), "n").agg(F.count(F.lit(1)).alias("times"))
    shared = seeds.join(wanted, "seed").groupBy("id", "h", "item_id", "item_h", "n").agg(F.sum("times").alias("times"))
    pairs = shared.where(F.col("times") * seed_words >= F.lit(coverage) * F.col("n"))
    pairs = staged(pairs.select(F.col("id").alias("pair_id"), F.col("h").alias("pair_h"), "item_id", "item_h"), "benchmark-pairs")
    texts = items.select(F.col("id").alias("i"), F.col("h").alias("ih"), F.col("text").alias("item_text")).dropDuplicates(["i", "ih"])
    same_item = F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_h") == F.col("ih"))
    named = pairs.join(texts, same_item).select("pair_id", "pair_h", "item_id", "item_text")
    same = F.col("id").eqNullSafe(F.col("pair_id")) & (F.col("h") == F.col("pair_h"))
    both = source.join(named, same).select("id", "h", "text", "item_id", "item_text")

    def tile(batches):
        for batch in batches:
            rows = []
            for text, item in zip(batch.column("text"), batch.column("item_text"), strict=True):
                item, text = words(item.as_py()), words(text.as_py())
                found = tiles(item, text, min(seed_words, len(item)))
                covered = sum(length for _, _, length in found)
                rows.append((len(item), covered, len(found), max((length for _, _, length in found), default=0)))
            numbers = longs(*np.array(rows, np.int64).reshape(-1, 4).T)
            columns = [batch.column("id"), batch.column("h"), batch.column("item_id"), *numbers]
            yield pa.RecordBatch.from_arrays(columns, ["id", "h", "item_id", "n_words", "n_covered", "n_tiles", "longest"])

    item_kind = items.schema["id"].dataType.simpleString()
    schema = f"id {kind}, h long, item_id {item_kind}, n_words long, n_covered long, n_tiles long, longest long"
    result = both.mapInArrow(tile, schema).dropDuplicates(["id", "h", "item_id", "n_words", "n_covered"])
    return result.withColumn("coverage", F.col("n_covered") / F.col("n_words")).where(F.col("coverage") >= coverage).drop("h")
