"""Look-ups in stored tables read the row groups they need."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse import contracts
from tallyhouse.operators import reports
from tallyhouse.sinks import files
from tallyhouse.sinks.outputs import OutputTarget, read_output, write_table
from tests.rows import many


def rows_read(df):
    """Rows that the only scan of ``df`` gave out, that is, of row groups it did not skip."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture
def small_groups(spark):
    """Row groups of some thousand rows."""
    before = spark.conf.get("parquet.block.size", None)
    spark.conf.set("parquet.block.size", str(64 << 10))
    yield
    spark.conf.unset("parquet.block.size") if before is None else spark.conf.set("parquet.block.size", before)


def test_one_merchant_reads_few_row_groups(spark, tmp_path, small_groups):
    day = F.lit("2025-06-24").cast("date")
    columns = {c: F.lit(None).cast(t).alias(c) for c, t in contracts.DAILY_MERCHANT_SUMMARY.columns.items()}
    columns |= {"merchant_id": F.concat(F.lit("m"), F.hash("id").cast("string")).alias("merchant_id"), "transaction_date": day.alias("transaction_date")}
    columns |= {c: F.lit(1).cast(t).alias(c) for c, t in contracts.DAILY_MERCHANT_SUMMARY.columns.items() if c.startswith("total_")}
    summary = spark.range(50_000).repartition(4).select(*columns.values())
    target = OutputTarget(str(tmp_path))
    write_table(summary, contracts.DAILY_MERCHANT_SUMMARY, target, "2025-06-24", empty=False)
    stored = read_output(spark, target, contracts.DAILY_MERCHANT_SUMMARY)
    assert stored.count() == 50_000
    name = stored.select("merchant_id").first()[0]
    found = reports.get_merchant_summary(stored, name, "2025-06-24", "2025-06-24")
    assert found.count() == stored.filter(F.col("merchant_id") == name).count() >= 1
    assert rows_read(stored.filter(F.col("merchant_id") == name)) < 25_000


def test_one_transaction_is_found_by_its_bloom_filter(spark, tmp_path, small_groups):
    """Ids are scattered over all merchants, so every row group has the least and the greatest around any id."""
    rows = many(spark, 50_000, transaction_id="sha2(cast(id AS string), 256)", merchant_id="concat('m', id % 97)")
    days = rows.withColumn(files.DAY, F.lit("2025-06-24"))
    for name, find_by in (("plain", ()), ("bloom", ("transaction_id",))):
        files.replace_days(days, f"{tmp_path}/{name}", cluster_by=["merchant_id"], find_by=find_by)
    wanted = F.col("transaction_id") == F.sha2(F.lit("no such number"), 256)
    plain, bloom = (rows_read(spark.read.parquet(f"{tmp_path}/{n}").filter(wanted)) for n in ("plain", "bloom"))
    assert bloom < plain / 2
    some = F.col("transaction_id") == F.sha2(F.lit("4711"), 256)
    assert spark.read.parquet(f"{tmp_path}/bloom").filter(some).count() == 1
