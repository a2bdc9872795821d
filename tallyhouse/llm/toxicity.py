"""Toxicity of texts by a counterfactually regularised linear classifier.

Features are words, their beginnings and the four-letter parts of words, hashed. From a bounded
sample of labelled rows Spark counts in how many toxic and other texts each feature occurs;
features that clearly lean to the toxic side are kept and scaled by their log ratio. A logistic model is
fitted to the sample, whose classes are weighted back to their real shares, toxic rows double. Labelled texts that
name a group of people are repeated with the name swapped for others of its kind, and the model
pays for every difference between the two scores, so that naming a group is not itself toxic.

Defined results: a null or empty text gets the score of the intercept alone; repeated rows get the
same score; without labelled rows of both kinds every text gets the smoothed share of toxic
labels. A row labelled twice counts as toxic if one label says so; null labels are left out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import id_and_text, staged, texts

FEATURES = 1 << 20
CACHED_WORDS = 400_000
STRIPPED = ".,;:!?#$%&*|\"'()[]{}<>-_/\\"

# Names of groups of people; a name may be swapped for any other of its line.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("blind", "deaf", "disabled", "autistic"),
    ("old", "young", "elderly", "teenage"),
)


def word_features(word: str) -> set[int]:
    word = word.strip(STRIPPED).lower()
    if not word:
        return set()
    parts = {"w" + word, *("p" + word[:n] for n in (3, 4, 5, 6) if len(word) > n)}
    parts.update("g" + word[i : i + 4] for i in range(1, len(word) - 3))
    return {zlib.crc32(part.encode()) % FEATURES for part in parts}


def text_features(text: str) -> set[int]:
    return set().union(*map(word_features, set(text.split())))


def swapped_texts(text: str, groups: Sequence[Sequence[str]], variants: int) -> list[str]:
    """The text with every group name replaced by another of its line, in up to ``variants`` ways."""
    place = {name: (line, i) for line in groups for i, name in enumerate(line)}
    if not place:
        return []
    pattern = re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, place), key=len, reverse=True)) + r")\b", re.IGNORECASE)

    def other(step):
        def swap(match):
            line, i = place[match[0].lower()]
            name = line[(i + step) % len(line)]
            return name.capitalize() if match[0][0].isupper() else name

        return swap

    swaps = [pattern.sub(other(step), text) for step in range(1, variants + 1)] if pattern.search(text) else []
    return [swap for swap in swaps if swap != text]


@dataclass
class ToxicityModel:
    weights: dict[int, float]
    intercept: float

    def probability(self, features: set[int]) -> float:
        z = self.intercept + sum(self.weights.get(f, 0.0) for f in features)
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def labelled_sample(labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` ids of each label, chosen by a hash of the id, and the size of each class."""
    known = labels.where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    sizes = {int(r["label"]): r["count"] for r in known.groupBy("label").count().collect()}
    order = [F.xxhash64("id"), F.col("id")]
    chosen = [known.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    return chosen[0].union(chosen[1]), sizes


def _sample_features(sample: DataFrame, groups: Sequence[Sequence[str]], variants: int) -> DataFrame:
    """(label, features, swapped): of each sampled text and of its swapped versions."""

    def compute(batches):
        for batch in batches:
            found, swapped = [], []
            for _, text in texts(batch):
                text = text.decode()
                found.append(sorted(text_features(text)))
                swapped.append([sorted(text_features(s)) for s in swapped_texts(text, groups, variants)])
            columns = [batch.column("label"), pa.array(found, pa.list_(pa.int32())), pa.array(swapped, pa.list_(pa.list_(pa.int32())))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "features", "swapped"])

    return sample.select("id", "text", "label").mapInArrow(compute, "label int, features array<int>, swapped array<array<int>>")


def _sparse(rows: list[list[int]], column: dict[int, int], scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the features in ``rows``."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.fromiter((column[f] for r in rows for f in r), np.int64, len(row))
    return row, at, scale[at]


def fit_logistic(
    rows: list[list[int]],
    labels: np.ndarray,
    row_weights: np.ndarray,
    pairs: list[tuple[list[int], list[int]]],
    ratios: dict[int, float],
    fairness: float,
    steps: int = 300,
    rate: float = 0.03,
    ridge: float = 3e-6,
) -> ToxicityModel:
    """Weighted logistic loss plus ``fairness`` times the mean squared score change over ``pairs``, by Adam."""
    column = {feature: i for i, feature in enumerate(ratios)}
    scale = np.fromiter(ratios.values(), float, len(ratios))
    row, at, value = _sparse(rows, column, scale)
    left, right = (_sparse([pair[side] for pair in pairs], column, scale) for side in (0, 1))
    change = [np.concatenate(x) for x in ((left[0], right[0]), (left[1], right[1]), (left[2], -right[2]))]
    weights = np.append(np.zeros(len(ratios)), -2.0)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    share = row_weights / row_weights.sum()
    for step in range(1, steps + 1):
        z = weights[-1] + np.bincount(row, weights[at] * value, len(rows))
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * share
        gradient = np.append(np.bincount(at, value * error[row], len(ratios)) + ridge * weights[:-1], error.sum())
        if pairs:
            gap = np.bincount(change[0], weights[change[1]] * change[2], len(pairs))
            gradient[:-1] += 2 * fairness / len(pairs) * np.bincount(change[1], change[2] * gap[change[0]], len(ratios))
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
    return ToxicityModel({f: float(weights[i] * scale[i]) for f, i in column.items()}, float(weights[-1]))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 8_000,
    min_rows: int = 4,
    min_ratio: float = 1.5,
    toxic_weight: float = 2.0,
    fairness: float = 1.0,
    groups: Sequence[Sequence[str]] = IDENTITY_TERMS,
    variants: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> ToxicityModel:
    """Fit on ``labels`` (id, label 0/1). The fit sees at most ``per_class`` rows of each label.

    A feature is used if it occurs in ``min_rows`` sampled texts and its log ratio is ``min_ratio``
    or more.
    """
    chosen, sizes = labelled_sample(labels, per_class)
    used = {k: min(n, per_class) for k, n in sizes.items()}
    if not sizes.get(0) or not sizes.get(1):
        share = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 1)
        return ToxicityModel({}, float(np.log(share / (1 - share))))
    chosen = staged(chosen.withColumnRenamed("id", "_id"), "toxicity-sample")
    source = id_and_text(docs, id_col, text_col)
    # The sample has at most 2 * per_class rows of 12 bytes, so it can be sent to every executor.
    sample = source.join(F.broadcast(chosen), source["id"] == chosen["_id"])
    sample = staged(_sample_features(sample.withColumn("label", F.col("label").cast("int")), groups, variants), "toxicity-features")

    counts = sample.select("label", F.explode("features").alias("f")).groupBy("f")
    counts = counts.agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))
    log_share = lambda c, k: F.log((F.col(c) + 0.5) / F.lit(used[k] + 1.0))
    counts = counts.select("f", (log_share("p", 1) - log_share("n", 0)).alias("ratio"), (F.col("p") + F.col("n")).alias("seen"))
    leaning = counts.where((F.col("seen") >= min_rows) & (F.col("ratio") >= min_ratio)).orderBy("f")
    ratios = {r["f"]: r["ratio"] for r in leaning.collect()}  # at most FEATURES rows

    wanted = sample.sparkSession.sparkContext.broadcast(set(ratios))

    def leaning_only(batches):
        pick = lambda fs: [f for f in fs if f in wanted.value]
        for batch in batches:
            data = batch.to_pydict()
            columns = [
                batch.column("label"),
                pa.array([pick(fs) for fs in data["features"]], pa.list_(pa.int32())),
                pa.array([[pick(fs) for fs in swaps] for swaps in data["swapped"]], pa.list_(pa.list_(pa.int32()))),
            ]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    rows = sample.mapInArrow(leaning_only, sample.schema).toArrow().to_pydict()
    labels_seen = np.array(rows["label"], float)
    row_weights = np.where(labels_seen == 1, toxic_weight * sizes[1] / used[1], sizes[0] / used[0])
    pairs = [(fs, swap) for fs, swaps in zip(rows["features"], rows["swapped"], strict=True) for swap in swaps]
    return fit_logistic(rows["features"], labels_seen, row_weights, pairs, ratios, fairness)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` columns stay; ``score_col`` between 0 and 1 is added (replacing a column of that name)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != score_col]
    names = [*kept, score_col]

    def score(batches):
        model = sent.value

        class Known(dict):
            def __missing__(self, word: bytes) -> tuple[int, ...]:
                found = self[word] = tuple(f for f in word_features(word.decode()) if f in model.weights)
                return found

        known = Known()
        for batch in batches:
            scores = []
            for text in batch.column(text_col):
                words = set((text.as_py() or "").encode().split())
                scores.append(model.probability(set().union(*map(known.__getitem__, words))))
                if len(known) > CACHED_WORDS:
                    known.clear()
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names)

    schema = docs.select(*kept).schema.add(score_col, "double")
    return docs.select(*kept).mapInArrow(score, schema)
