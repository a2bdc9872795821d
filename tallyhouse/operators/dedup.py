"""Deterministic removal of repeated transactions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NULL_SPREAD = "_null_spread"
_FIRST = "_first"


def dedup_transactions(
    df: DataFrame,
    keys: Sequence[str] = ("transaction_id",),
    order_by: Sequence[str] | None = None,
    copies_col: str | None = None,
    collapse_null_keys: bool = False,
) -> DataFrame:
    """Keep one row per key: the first by ``order_by``, ties broken by the other columns.

    Without ``order_by`` the earliest ``timestamp`` wins (NULLs last). The order is
    total, so the survivor does not depend on how the input is partitioned. Every column
    must be of a type Spark can order, which leaves out maps.

    The survivor is a ``min`` over structs: every map task reduces its own copies of a
    key to one row before the shuffle, so a key that holds a third of the input sends
    one row per task rather than all of them. ``copies_col`` also returns how many rows
    each survivor stands for, which saves a separate count of the input.

    Rows in which a key is NULL are all kept (several broken files must stay visible),
    unless ``collapse_null_keys`` asks for the one-row reading. They are spread over the
    reducers by their position in the input instead of meeting in one group. Positions
    are the same in every attempt at a task that reads files; behind a shuffle, whose row
    order may change, the checksum settings in ``session`` make Spark notice.
    """
    keys = list(keys)
    if order_by is None:
        order_by = ["timestamp"] if "timestamp" in df.columns and "timestamp" not in keys else []
    rest = [F.col(c) for c in df.columns if c not in keys and c not in order_by]

    ordering = []
    for i, name in enumerate(order_by):
        ordering += [F.col(name).isNull().alias(f"_null_{i}"), F.col(name)]
    first = F.min(F.struct(*(ordering + rest or [F.lit(0)]))).alias(_FIRST)
    measures = [first, F.count(F.lit(1)).alias(copies_col)] if copies_col else [first]

    if collapse_null_keys:
        grouped = df.groupBy(*keys).agg(*measures)
    else:
        null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        spread = F.when(null_key, F.monotonically_increasing_id())
        grouped = df.withColumn(_NULL_SPREAD, spread).groupBy(*keys, _NULL_SPREAD).agg(*measures)

    columns = [F.col(c) if c in keys else F.col(_FIRST)[c].alias(c) for c in df.columns]
    if copies_col:
        columns.append(F.col(copies_col))
    return grouped.select(*columns)
