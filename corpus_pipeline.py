"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of
``documents``. Every stage works on what its predecessor kept. SQL cannot express the classifier,
the fingerprints and the tokenizer, so there is no oracle; tests hold the stages against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import free_name, staged, table
from tallyhouse.llm.decontamination import contaminated
from tallyhouse.llm.exact_dedup import drop_copies
from tallyhouse.llm.packing import pack
from tallyhouse.llm.queries import TOXIC_FROM, toxicity_model
from tallyhouse.llm.simhash import drop_near_duplicates
from tallyhouse.llm.toxicity import score_toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "_toxicity")
    return score_toxicity(docs, model, score_col=score).where(F.col(score) < TOXIC_FROM).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose five-word shingles are alike to 0.8 or more the document with the smallest id.

    SimHash fingerprints discard pairs by their pivot distances and bits; the sets of the others decide.
    """
    return drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    pairs = contaminated(docs, table(spark, sf_dir, "benchmark"))
    key = free_name(docs, "_leak")
    leaks = staged(pairs.select(F.col("id").alias(key)).distinct(), "leaks")
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks[key]), "left_anti")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens, with their ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
