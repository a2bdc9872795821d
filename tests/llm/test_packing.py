from __future__ import annotations

import functools
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import packing
from tallyhouse.llm.packing import WordIds, closest_fill, pack

PATH = public_tokenizers.path("word_bpe_49k.json")

AWKWARD = [
    "", None, "  \n", "Hello, world. It's ABC's 12,345!", "a#. b###. c.,;d e!!!? .,;", "Straße ÉCOLE éa éa İI Σας\x1cx a\x85b a b",
    "<|endoftext|> <|EndOfText|> x<|startoftext|>.", "µª º1. ß. 中文 mixed中. 😀😀!", "word " * 9000,
]


TOKENIZER = Tokenizer.from_file(PATH)


@functools.lru_cache(None)
def expected_ids(text: str | None) -> list[int]:
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


def test_word_cache_gives_the_tokenizers_ids(spark, small):
    words = WordIds(PATH)
    texts = AWKWARD + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    for text in texts:
        found = np.frombuffer(words.of_text((text or "").encode()), "<u4").tolist()
        assert found + [2] == expected_ids(text)


def test_closest_fill_is_optimal():
    draw = random.Random(1)
    for _ in range(200):
        items = [draw.randint(1, 40) for _ in range(draw.randint(0, 9))]
        capacity = draw.randint(1, 100)
        counts = {n: items.count(n) for n in set(items)}
        taken = closest_fill(sorted(counts), counts, capacity)
        assert all(0 < k <= counts[n] for n, k in taken.items())
        sums = {sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k)}
        assert sum(n * k for n, k in taken.items()) == max(s for s in sums if s <= capacity)


def check_pieces(rows, texts: dict, capacity: int) -> None:
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for key, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        ids = b"".join(bytes(p.ids) for p in pieces)
        assert np.frombuffer(ids, "<u4").tolist() == expected_ids(texts[key])
        assert [p.start for p in pieces] == [0, *itertools.accumulate(p.length for p in pieces)][:-1]
        assert all(p.doc_tokens == len(ids) // 4 and p.length * 4 == len(p.ids) for p in pieces)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [0, *itertools.accumulate(p.length for p in pieces)][:-1]
        total = sum(p.length for p in pieces)
        assert total <= capacity and (total == capacity or total & (total - 1) == 0)


def test_round_trip_of_awkward_texts(spark):
    texts = dict(enumerate(AWKWARD))
    docs = spark.createDataFrame([(k, t, "x", 7) for k, t in texts.items()], "doc_id long, text string, ids string, offset int")
    check_pieces(pack(docs.coalesce(1), PATH).collect(), texts, 4096)


def test_small_windows_and_capacity(spark, small, monkeypatch):
    monkeypatch.setattr(packing, "WINDOW_TOKENS", 5000)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_pieces(pack(docs.repartition(3), PATH, capacity=1000).collect(), texts, 1000)


def test_query_carries_the_checksums(spark, small):
    from tallyhouse.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op2_packing"](spark, small).collect()
    for r in rows:
        piece = np.array(expected_ids(texts[r.doc_id])[r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(piece.tobytes())
    assert sum(r.length for r in rows) == sum(len(expected_ids(t)) for t in texts.values())


def test_empty_table_and_bad_capacity(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack(empty, PATH).count() == 0
    with pytest.raises(ValueError):
        pack(empty, PATH, capacity=0)
