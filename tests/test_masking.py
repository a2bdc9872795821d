from __future__ import annotations

import hashlib

import pytest

from tallyhouse.operators import masking
from tallyhouse.operators.cleaning import clean_transactions
from tests.rows import transactions


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(
    ("card", "mask"),
    [
        ("4111111111111234", "************1234"),
        ("411111", "************1111"),
        ("1234", "************1234"),
        ("123", "****************"),
        (None, "****************"),
    ],
)
def test_card_mask(spark, card, mask):
    assert masking.mask_card_number(transactions(spark, {"card_number": card})).first().card_number_masked == mask


def test_hashes(spark):
    df = transactions(spark, {"amount": 100.0})
    row = masking.apply_all_masking(df).first()
    assert row.customer_id_hash == sha("c1")
    assert row.transaction_hash == sha("t1" + "m1" + "100.0" + "2025-06-24 00:41:05")
    assert "card_number" not in row and "customer_id" not in row


def test_hash_text_is_the_same_for_money_and_doubles(spark):
    df = transactions(spark, {"amount": 100.0})
    exact = df.withColumn("amount", df.amount.cast("decimal(15,2)"))
    assert masking.transaction_hash(df).first().transaction_hash == masking.transaction_hash(exact).first().transaction_hash


def test_parts_can_be_separated(spark):
    df = transactions(spark, {"transaction_id": "a", "merchant_id": "bc"}, {"transaction_id": "ab", "merchant_id": "c"})
    assert masking.transaction_hash(df).select("transaction_hash").distinct().count() == 1
    assert masking.transaction_hash(df, separator="|").select("transaction_hash").distinct().count() == 2


def test_a_missing_part_gives_no_hash(spark):
    assert masking.transaction_hash(transactions(spark, {"amount": None})).first().transaction_hash is None


def test_salt_changes_the_customer_hash(spark):
    assert masking.hash_customer_id(transactions(spark, {}), salt="pepper").first().customer_id_hash == sha("pepperc1")


def test_environments(spark):
    df = clean_transactions(transactions(spark, {}))
    raw = {"card_number", "customer_id"}
    columns = {name: set(masking.mask_for_environment(df, name).columns) for name in ("PRODUCTION", "Staging", "development", "moon")}
    assert not raw & columns["PRODUCTION"]
    assert columns["moon"] == columns["PRODUCTION"]
    assert raw <= columns["Staging"] and "transaction_hash" in columns["Staging"]
    assert "customer_id_hash" not in columns["Staging"]
    assert raw <= columns["development"] and "transaction_hash" not in columns["development"]
    assert all("card_number_masked" in c for c in columns.values())


def test_secure_dataset_takes_listed_columns_only(spark):
    df = masking.transaction_hash(masking.mask_card_number(clean_transactions(transactions(spark, {}))))
    assert masking.secure_dataset(df).columns == [
        "transaction_id", "merchant_id", "amount", "currency", "timestamp",
        "transaction_date", "transaction_hour", "location", "transaction_hash",
    ]


def test_location_defaults_to_itself(spark):
    assert masking.generalise_location(transactions(spark, {})).first().location_generalized == "Norfield"


def test_region_map_never_multiplies_rows(spark):
    df = transactions(spark, {}, {"location": "Elsewhere"}, {"location": None})
    regions = spark.createDataFrame([("Norfield", "South"), ("Norfield", "North")], "location string, region string")
    result = masking.generalise_location(df, regions)
    assert sorted(map(str, (r.location_generalized for r in result.collect()))) == ["None", "North", "OTHER"]
    assert result.columns == [*df.columns, "location_generalized"]


def labels(spark, rows, k, levels=("region",)):
    names = {"Oslo": "North", "Bergen": "North", "Rome": "South", "Bari": "South", "Kyiv": "East"}
    hierarchy = spark.createDataFrame([(a, b, "Europe") for a, b in names.items()], "location string, region string, continent string")
    df = transactions(spark, *[{"transaction_id": f"{place}{i}", "location": place} for place, n in rows for i in range(n)])
    made = masking.generalise_location_k(df, hierarchy, k, levels).collect()
    assert len(made) == sum(n for _, n in rows)
    return {(r.location, r.location_generalized) for r in made}


def test_locations_climb_until_enough_rows_share_them(spark):
    rows = [("Oslo", 5), ("Bergen", 2), ("Rome", 1), ("Bari", 2), ("Kyiv", 1), ("Atlantis", 2), (None, 4)]
    assert labels(spark, rows, 3) == {
        ("Oslo", "Oslo"), ("Bergen", "*"), ("Rome", "South"), ("Bari", "South"), ("Kyiv", "*"), ("Atlantis", "*"), (None, None),
    }
    assert labels(spark, rows, 6) == {
        ("Oslo", "North"), ("Bergen", "North"), ("Rome", "*"), ("Bari", "*"), ("Kyiv", "*"), ("Atlantis", "*"), (None, None),
    }
    # Two levels: what is rare in its region goes by the continent; what is rare even at the top has no label.
    assert labels(spark, [("Oslo", 1), ("Rome", 1), ("Kyiv", 1), ("Atlantis", 1)], 3, ("region", "continent")) == {
        ("Oslo", "Europe"), ("Rome", "Europe"), ("Kyiv", "Europe"), ("Atlantis", None),
    }
    assert labels(spark, [("Oslo", 1)], 1) == {("Oslo", "Oslo")}


@pytest.mark.parametrize("k", [1, 4, 9, 50])
def test_no_label_is_shared_by_fewer_than_k_rows(spark, k):
    from collections import Counter

    rows = [("Oslo", 9), ("Bergen", 4), ("Rome", 3), ("Bari", 1), ("Kyiv", 2), ("Atlantis", 7)]
    hierarchy = spark.createDataFrame([("Oslo", "North"), ("Bergen", "North"), ("Rome", "South"), ("Bari", "South")], "location string, region string")
    df = transactions(spark, *[{"transaction_id": f"{p}{i}", "location": p} for p, n in rows for i in range(n)])
    counts = Counter(r.location_generalized for r in masking.generalise_location_k(df, hierarchy, k).collect())
    assert all(n >= k for label, n in counts.items() if label is not None)
