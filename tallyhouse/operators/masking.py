"""Masking of sensitive columns. Row-local: no shuffle, except for a region map."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import privacy

log = logging.getLogger(__name__)

# The columns a reporting data set may contain.
SECURE_COLUMNS = [
    "transaction_id",
    "merchant_id",
    "amount",
    "currency",
    "timestamp",
    "transaction_date",
    "transaction_hour",
    "location",
    "completeness_score",
    "transaction_hash",
]


def _transaction_hash(separator: str = ""):
    parts = [F.col(c) for c in ("transaction_id", "merchant_id", "amount", "timestamp")]
    return privacy.audit_hash(*parts, separator=separator)


def mask_card_number(df: DataFrame) -> DataFrame:
    return df.withColumn("card_number_masked", privacy.card_mask(F.col("card_number")))


def hash_customer_id(df: DataFrame, salt: str | None = None) -> DataFrame:
    return df.withColumn("customer_id_hash", privacy.customer_hash(F.col("customer_id"), salt))


def transaction_hash(df: DataFrame, separator: str = "") -> DataFrame:
    return df.withColumn("transaction_hash", _transaction_hash(separator))


def generalise_location(df: DataFrame, regions: DataFrame | None = None, other: str = "OTHER") -> DataFrame:
    """Add ``location_generalized``: the location itself, or its region if a map is given.

    ``regions`` holds (location, region). It is reduced to one region per location, so
    it can never multiply rows. Spark broadcasts it only if its size is below the
    session's threshold; a larger map is joined by shuffle, where adaptive execution
    splits hot locations.
    """
    if regions is None:
        return df.withColumn("location_generalized", F.col("location"))
    lookup = regions.groupBy("location").agg(F.min("region").alias("_region"))
    generalized = F.when(F.col("location").isNotNull(), F.coalesce("_region", F.lit(other)))
    return (
        df.join(lookup, "location", "left")
        .withColumn("location_generalized", generalized)
        .select(*df.columns, "location_generalized")
    )


def generalise_location_k(df: DataFrame, hierarchy: DataFrame, k: int, levels: Sequence[str] = ("region",), top: str = "*") -> DataFrame:
    """Add ``location_generalized`` so that at least ``k`` rows share every value of it.

    ``hierarchy`` holds (location, *levels), finest level first. A location with ``k`` rows stays; the
    rest climb a level, and stay where the rows that climbed to one value are ``k``; what still is
    too rare becomes ``top``, and NULL if even that stands for fewer than ``k`` rows. Rows without a
    location keep none. Locations that the hierarchy does not know climb straight to the top.

    Everything is decided over one row per location: the rows themselves are read once to be
    counted, and joined once to their label, by shuffle only if locations are too many to broadcast.
    """
    if k < 1:
        raise ValueError("a group has at least one row")
    known = hierarchy.groupBy("location").agg(*[F.min(level).alias(level) for level in levels])
    names = df.where(F.col("location").isNotNull()).groupBy("location").agg(F.count(F.lit(1)).alias("_rows")).join(known, "location", "left")
    names = names.withColumn("_label", F.lit(None).cast("string"))
    for value in (F.col("location"), *[F.col(level) for level in levels], F.lit(top)):
        names = names.withColumn("_value", F.when(F.col("_label").isNull(), value))
        enough = F.sum("_rows").over(Window.partitionBy("_value")) >= k
        names = names.withColumn("_label", F.coalesce("_label", F.when(enough, F.col("_value"))))
    lookup = names.select("location", F.col("_label").alias("location_generalized"))
    return df.join(lookup, "location", "left").select(*df.columns, "location_generalized")


def apply_all_masking(df: DataFrame, salt: str | None = None, separator: str = "") -> DataFrame:
    """Masked card, customer hash and transaction hash; the raw card and customer are gone."""
    return df.withColumns(
        {
            "card_number_masked": privacy.card_mask(F.col("card_number")),
            "customer_id_hash": privacy.customer_hash(F.col("customer_id"), salt),
            "transaction_hash": _transaction_hash(separator),
        }
    ).drop("card_number", "customer_id")


def secure_dataset(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in SECURE_COLUMNS if c in df.columns])


# What each environment masks; only production drops the raw columns.
ENVIRONMENT_STEPS = {
    "production": (apply_all_masking,),
    "development": (mask_card_number,),
    "staging": (mask_card_number, transaction_hash),
}


def mask_for_environment(df: DataFrame, environment: str = "production") -> DataFrame:
    """Masking by environment name, in any case; an unknown name gets full masking.

    Staging and development keep the raw columns next to the masked ones.
    """
    steps = ENVIRONMENT_STEPS.get(environment.lower())
    if steps is None:
        log.warning("no masking is defined for %r; it gets everything masked", environment)
        steps = (apply_all_masking,)
    return reduce(lambda frame, step: step(frame), steps, df)
