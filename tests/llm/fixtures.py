"""Small awkward tables: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, id long, h long, start long, kept boolean, component long, score double, digest string"


def words(draw: random.Random, n: int, size: int = 400) -> list[str]:
    return [f"w{draw.randint(0, size)}" for _ in range(n)]


def awkward_texts(seed: int = 3) -> list[tuple[int | None, str | None]]:
    draw = random.Random(seed)
    base, other = words(draw, 180), words(draw, 130)
    near = base.copy()
    near[60] = "changed"
    passage = words(draw, 70)
    texts = [
        (1, None), (2, ""), (3, "  \n\t "), (4, "One"), (5, "one two"), (6, "ONE two"),
        (7, " ".join(base)), (8, " ".join(base)), (9, " ".join(near)), (10, " ".join(base[20:150])),
        (11, " ".join(other)), (12, " ".join(other[:40] + passage + other[40:])), (13, " ".join(passage + base[:60])),
        (14, "again " * 400), (15, "again " * 300), (16, "a" * 700), (17, "äöü ß 中文 " * 60),
        (20, " ".join(words(draw, 6000))), (21, " ".join(passage[:45])), (22, "  ".join(passage)),
        (7, " ".join(base)), (None, " ".join(base)), (None, None),
    ]
    return texts


def awkward(spark, texts=None, partitions: int = 3):
    rows = [(key, text, "x", 5, 6, 7, False, 8, 0.5, "d") for key, text in (awkward_texts() if texts is None else texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
