"""Removal of word passages that an earlier document has, by fixed-block anchors.

Every document is cut into non-overlapping blocks of half a window; a passage as long as a window
holds at least one of them whole. The blocks are the index. Every rolling stretch of block length
probes it: both sides go by their least six-word gram and its place in the stretch, so that the
many stretches which share one gram ask once and only the places at which a block has that gram
are compared. Grams found in a single document are dropped first. Hits are then extended to
maximal exact repeats: a hit stands for the windows that hold it, their names are ranked by Spark,
and where the same block goes on differently the windows are split up until single ones decide.

Defined results: words are runs of bytes other than ASCII white space; a null text has none; texts
shorter than a window lose nothing; of rows with one id neither counts as earlier; rows without an
id lose nothing and take nothing from others; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import drop_staged, staged
from tallyhouse.llm.repeats import UNIT, Repeats, Symbols, documents, longs, marked, per_document, with_ranges
from tallyhouse.llm.rolling import Rolling, anchors, covered, mix, segments

GRAM = 6


def _cutter(symbols: Symbols) -> Callable[[bytes, np.ndarray, np.ndarray], list[bytes]]:
    def cut(text: bytes, start: np.ndarray, length: np.ndarray) -> list[bytes]:
        found = symbols.of_words(text).symbols
        return [found[a : a + n].tobytes() for a, n in zip(start.tolist(), length.tolist(), strict=True)]

    return cut


def _symbols(content: bytes) -> np.ndarray:
    return np.frombuffer(content, np.uint64)


def _grams(symbols: np.ndarray, block: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every stretch of ``block`` words the place of its least gram; the distinct places and their grams."""
    places, found = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    of_stretch = [np.empty(0, np.int64)]
    for at, part in segments(symbols, block):
        rolling = Rolling(part)
        place = anchors(rolling, gram, block - gram + 1)[: len(part) - block + 1]
        distinct = np.unique(place)
        of_stretch.append(place + at)
        places.append(distinct + at)
        found.append(mix(rolling.of(distinct, gram)))
    return np.concatenate(of_stretch), np.concatenate(places), np.concatenate(found)


def probes(docs: DataFrame, window: int, block: int, gram: int, named: Symbols) -> DataFrame:
    """(id, h, gram, place, offset): the grams stretches go by, with offset -1, and the index of
    blocks, with the gram's offset in the block."""

    def compute(row):
        symbols = named.of_words(row["text"]).symbols
        if len(symbols) < window:
            return None
        of_stretch, places, grams = _grams(symbols, block, gram)
        starts = np.arange(0, len(of_stretch), block)
        at = of_stretch[starts]
        block_grams = grams[np.searchsorted(places, at)]
        offset = np.concatenate((np.full(len(places), -1), at - starts))
        return np.concatenate((grams, block_grams)), np.concatenate((places, at)), offset

    kind = docs.schema["id"].dataType.simpleString()
    names = ["gram", "place", "offset"]
    return docs.mapInArrow(
        lambda batches: per_document(batches, compute, names, ["id", "h"]), f"id {kind}, h long, gram long, place long, offset long"
    )


def hits(found: DataFrame) -> DataFrame:
    """(id, h, start): stretches that may equal a block, from staged ``probes``."""
    asked = found.where("offset < 0").drop("offset")
    shared = asked.groupBy("gram").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("gram")
    # Staged, so that the join has plain shuffles on both sides and Spark splits a hot gram.
    index = staged(found.where("offset >= 0").select("gram", "offset").distinct().join(shared, "gram"), "block-index")
    candidates = asked.join(index, "gram").where("place >= offset")
    return candidates.select("id", "h", (F.col("place") - F.col("offset")).alias("start"))


def units_at_hits(docs: DataFrame, found: DataFrame, window: int, block: int, named: Symbols) -> DataFrame:
    """The unit of every hit: the windows that hold the stretch, with the stretch as their core."""
    wanted = found.groupBy("id", "h").agg(F.collect_list("start").alias("starts"))
    wanted = wanted.select(F.col("id").alias("wanted_id"), F.col("h").alias("wanted_h"), "starts")
    same = (docs["id"] == wanted["wanted_id"]) & (docs["h"] == wanted["wanted_h"])

    def compute(row):
        symbols = named.of_words(row["text"]).symbols
        rolling = Rolling(symbols)
        at = np.unique(np.array(row["starts"], np.int64))
        at = at[at + block <= len(symbols)]
        start = np.maximum(at - (window - block), 0)
        count = np.minimum(at, len(symbols) - window) - start + 1
        at, start, count = at[count > 0], start[count > 0], count[count > 0]
        return mix(rolling.of(at, block)), covered(rolling, start, count, at - start, window), start, count, at - start

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, h long, core long, full long, start long, count long, shift long"
    source = docs.join(wanted, same).select("id", "h", "text", "starts")
    return source.mapInArrow(lambda batches: per_document(batches, compute, UNIT, ["id", "h"]), schema)


def repeated_words(docs: DataFrame, window: int) -> DataFrame:
    """(id, h, start, count): starts of windows of words that a row of a smaller id has as well."""
    block = max(1, (window + 1) // 2)
    gram = min(GRAM, block)
    known = docs.where("id is not null")
    symbols = Symbols(secrets.token_bytes(16))
    found = staged(probes(known, window, block, gram, symbols), "block-probes")
    asked = staged(hits(found), "block-hits")
    drop_staged(found)
    units = staged(units_at_hits(known, asked, window, block, symbols), "block-units")
    return Repeats(window, _cutter(symbols), _symbols, (5, 1) if block > 5 else (1,), earlier=True, symbol_bytes=8).repeated(units, known)


def block_dedup(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept) of every row; ``kept`` are the words that stay, joined by a space."""
    source = documents(docs, id_col, text_col)
    joined = with_ranges(source, staged(repeated_words(source, window), "repeated-words"))

    def compute(batches):
        for batch in batches:
            size, removed, digest, kept = [], [], [], []
            for text, ranges in zip(batch.column("text"), batch.column("ranges"), strict=True):
                words = text.as_py().split()
                gone = marked(ranges, len(words), window)
                stays = b" ".join(words if not gone.any() else [w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                size.append(len(words))
                removed.append(int(gone.sum()))
                digest.append(hashlib.sha256(stays).hexdigest())
                kept.append(stays)
            columns = [*longs(np.array(size, np.int64), np.array(removed, np.int64)), pa.array(digest, pa.string()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n_words", "n_removed", "kept_sha256", "kept"])

    kind = source.schema["id"].dataType.simpleString()
    return joined.mapInArrow(compute, f"id {kind}, n_words long, n_removed long, kept_sha256 string, kept binary")
