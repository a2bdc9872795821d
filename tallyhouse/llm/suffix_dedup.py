"""Removal of byte strings that occur more than once, by ranking suffixes in groups.

Ranking every position of a corpus at growing offsets moves more data than the corpus itself in every
round, so this is prefix doubling run backwards, over anchors. Each window of ``length`` bytes has
an anchor, the least 16-byte gram among its first hundred places; neighbouring windows share it, and
equal windows have it at equal places. Anchors take the part of suffixes: Spark groups pairs of
names, that of the bytes all windows of an anchor share and that of everything they cover, drops
what is unique, and names what is left again over fewer starts (100, then 10, then 1), until a name
is unique or stands for single windows. Names are fingerprints over symbols drawn for the run.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing; a repeated row
counts as another occurrence, so both lose what they share; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.common import staged
from tallyhouse.llm.repeats import UNIT, Repeats, Symbols, documents, marked, per_document, with_ranges
from tallyhouse.llm.rolling import window_runs

GRAM = 16


def _cut(text: bytes, start: np.ndarray, length: np.ndarray) -> list[bytes]:
    return [text[a : a + n] for a, n in zip(start.tolist(), length.tolist(), strict=True)]


def repeated_bytes(docs: DataFrame, length: int) -> DataFrame:
    """(id, h, start, count): starts of windows of ``length`` bytes that also start elsewhere. ``docs`` is (id, h, text)."""
    width = max(1, min(100, length - GRAM + 1))
    gram = min(GRAM, length)
    symbols = Symbols(secrets.token_bytes(16))

    def compute(row):
        return window_runs(symbols.of_bytes(row["text"]), length, gram, width)

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, h long, core long, full long, start long, count long, shift long"
    units = docs.mapInArrow(lambda batches: per_document(batches, compute, UNIT, ["id", "h"]), schema)
    sizes = (10, 1) if width > 10 else (1,)
    return Repeats(length, _cut, symbols.of_bytes, sizes).repeated(staged(units, "suffix-units"), docs)


def suffix_dedup(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row; ``kept`` are the bytes that stay."""
    source = documents(docs, id_col, text_col)
    joined = with_ranges(source, staged(repeated_bytes(source, length), "repeated-bytes"))

    def compute(batches):
        for batch in batches:
            rows = []
            for text, ranges in zip(batch.column("text"), batch.column("ranges"), strict=True):
                text = text.as_py()
                gone = marked(ranges, len(text), length)
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[:1].sum())
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if spans else text
                rows.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names)

    kind = source.schema["id"].dataType.simpleString()
    return joined.mapInArrow(compute, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
