from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyhouse.operators.dedup import dedup_transactions
from tests.rows import GOOD, many, transactions

EARLY, LATE = dt.datetime(2025, 6, 24, 1), dt.datetime(2025, 6, 24, 2)


def test_earliest_timestamp_wins_and_null_comes_last(spark):
    df = transactions(
        spark,
        {"timestamp": None, "location": "A"},
        {"timestamp": LATE, "location": "B"},
        {"timestamp": EARLY, "location": "C"},
    )
    assert [r.location for r in dedup_transactions(df).collect()] == ["C"]


def test_ties_are_broken_by_the_other_columns(spark):
    df = transactions(spark, {"location": "B"}, {"location": "A"})
    assert [r.location for r in dedup_transactions(df).collect()] == ["A"]


def test_survivors_do_not_depend_on_partitioning(spark):
    df = many(spark, 600, transaction_id="concat('t', id % 100)", location="concat('L', id % 7)", amount="CAST(id % 13 AS DOUBLE)")
    results = [
        sorted(map(tuple, dedup_transactions(layout).collect()))
        for layout in (df.coalesce(1), df.repartition(7), df.repartition(5, "location"))
    ]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 100


def test_columns_and_types_are_kept(spark):
    df = transactions(spark, {}, {"transaction_id": "t2"})
    assert dedup_transactions(df).schema.simpleString() == df.schema.simpleString()


def test_rows_without_an_id_all_stay(spark):
    df = transactions(spark, *[{"transaction_id": None}] * 5, {}, {})
    assert dedup_transactions(df).filter("transaction_id IS NULL").count() == 5
    assert dedup_transactions(df).count() == 6
    assert dedup_transactions(df, collapse_null_keys=True).count() == 2


def test_blank_ids_are_one_key(spark):
    assert dedup_transactions(transactions(spark, {"transaction_id": ""}, {"transaction_id": ""})).count() == 1


def test_copies_add_up_to_the_input(spark):
    df = many(spark, 300, transaction_id="CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('t', id) END")
    result = dedup_transactions(df, copies_col="copies")
    assert result.agg(F.sum("copies")).first()[0] == 300
    assert result.filter("transaction_id = 'hot'").first().copies == 100
    assert result.count() == 1 + 100 + 100


def test_hot_ids_are_reduced_before_the_shuffle(spark):
    df = many(spark, 100, transaction_id="concat('t', id % 10)")
    plan = dedup_transactions(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    below = plan[plan.index("Exchange") :]
    assert "partial_min" in below


def test_rows_without_an_id_are_spread_over_the_reducers(spark):
    """A third of the input without an id must not meet in one task."""
    df = many(spark, 4000, transaction_id="CAST(NULL AS STRING)").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = dedup_transactions(df).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in sizes) == 4000
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 2000


def test_given_order_and_composite_keys(spark):
    df = spark.createDataFrame([(1, 1, 9), (1, 1, 3), (1, 2, 5)], "a int, b int, seq int")
    rows = dedup_transactions(df, keys=["a", "b"], order_by=["seq"]).collect()
    assert sorted(map(tuple, rows)) == [(1, 1, 3), (1, 2, 5)]


def test_keys_only(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",)], "transaction_id string")
    assert sorted(r[0] for r in dedup_transactions(df, order_by=[]).collect()) == ["x", "y"]


def test_an_invalid_copy_may_win_over_a_valid_one(spark):
    """Dedup comes before validation; the order decides, not the quality."""
    df = transactions(spark, {"timestamp": LATE}, {"timestamp": EARLY, "amount": -1.0})
    assert dedup_transactions(df).first().amount == -1.0
    assert GOOD["amount"] > 0
