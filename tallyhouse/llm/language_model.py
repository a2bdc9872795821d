"""An interpolated modified Kneser-Ney bigram model, counted by Spark and read by memory map.

1. Spark counts the words of the training texts. Their hashes, sorted, are the vocabulary: a word's
   id is its place there.
2. Spark counts pairs of ids. Pairs are named by a scrambled 64-bit number, which spreads frequent
   words evenly; sorted by it they are written as arrays of numbers and counts, one file for each
   range of numbers. From the same pass come, per word, in how many kinds of pairs it is second and
   how many pairs that it begins occur once, twice and more often.
3. Workers map these files and look whole batches of pairs up by binary search.

The files lie in the folder the cluster names in ``spark.checkpoint.dir``. It must be a folder that
driver and executors have mounted, as only such files can be mapped. A file appears under its name
when it is complete, and a task that runs again writes the same bytes.

Defined results: a null or empty text is its end token alone; repeated rows count as often as they
occur; without training texts every token has the probability of an unknown word. A to Z are folded
to a to z, and words are runs of bytes other than ASCII white space.
"""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import id_and_text, staged, texts
from tallyhouse.llm.repeats import longs, word_symbols
from tallyhouse.llm.rolling import mix
from tallyhouse.session import scratch_path

END = np.uint64(0xE0D)  # the end token in the place of a word's hash
CHUNK = 1 << 22  # pairs that a task counts before it sends them on
RANGE_TOKENS = 1 << 18  # training tokens for each file of pairs, on average
MAX_WORDS = (1 << 32) - 2


def mounted_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared scratch folder, as a path to open."""
    uri = urlparse(scratch_path(spark, name))
    if uri.scheme not in ("", "file"):
        raise ValueError(f"the model is memory-mapped: {uri.scheme}:// is not a mounted folder, set spark.checkpoint.dir to one")
    os.makedirs(path := unquote(uri.path), exist_ok=True)
    return path


def _unmix(values: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    back = lambda v, s: v ^ v >> np.uint64(s) ^ v >> np.uint64(2 * s)
    values = back(values, 31) * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    values = back(values, 27) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return back(values, 30)


def _save(path: str, *arrays: np.ndarray) -> None:
    part = f"{path}.{TaskContext.get().taskAttemptId()}"
    with open(part, "wb") as out:
        for array in arrays:
            out.write(array.tobytes())
    os.replace(part, path)


def _narrowed(counts: np.ndarray, kind: str) -> np.ndarray:
    """``counts`` as numbers of ``kind``; one that does not fit is an error."""
    limits = np.iinfo(kind)
    if counts.size and (counts.min() < limits.min or counts.max() > limits.max):
        raise OverflowError(f"a count of {counts.max()} does not fit {limits.dtype}")
    return counts.astype(kind)


class SortedArrays:
    """Sorted 64-bit keys with a number each, in one file per range of keys."""

    def __init__(self, folder: str, bits: int, value: str, written: list[int] | None = None):
        """``written`` are the ranges that have a file; without it every range that is asked for has one."""
        self.folder, self.bits, self.value = folder, bits, np.dtype(value)
        self.written = None if written is None else set(written)
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def part(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        if number not in self.open:
            if self.written is not None and number not in self.written:
                self.open[number] = np.empty(0, np.uint64), np.empty(0, self.value)
            else:  # a file that is not there is an error: the folder is not mounted here
                path = f"{self.folder}/{number}"
                size = os.path.getsize(path) // (8 + self.value.itemsize)
                keys = np.memmap(path, np.uint64, "r", 0, (size,))
                self.open[number] = keys, np.memmap(path, self.value, "r", 8 * size, (size,))
        return self.open[number]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(range, place in it or -1, number or 0) of ascending distinct ``keys``."""
        numbers = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        place, value = np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        edges = np.flatnonzero(np.diff(numbers, prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            known, values = self.part(int(numbers[a]))
            if len(known):
                at = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
                found = known[at] == keys[a:b]
                place[a:b] = np.where(found, at, -1)
                value[a:b] = np.where(found, values[at], 0)
        return numbers, place, value


def _write_ranges(rows: DataFrame, folder: str, bits: int, value: str, stats=None, schema: str = "part long, n long") -> DataFrame:
    """Write ``rows`` (part, key, c), which need not be summed yet, as sorted arrays; one task has all of a part.

    Returns (part, n) per file, or what ``stats`` makes of a task's files.
    """
    os.makedirs(folder, exist_ok=True)
    summed = rows.repartition("part").groupBy("part", "key").agg(F.sum("c").alias("c")).sortWithinPartitions("part", "key")

    def write(batches):
        part, keys, counts, written = None, [], [], []

        def close():
            k, c = np.concatenate(keys).view(np.uint64), np.concatenate(counts)
            _save(f"{folder}/{part}", k, _narrowed(c, value))
            written.append((part, len(k)))
            return stats(k, c) if stats else None

        for batch in batches:
            numbers = batch.column("part").to_numpy()
            key, count = batch.column("key").to_numpy(), batch.column("c").to_numpy()
            edges = np.flatnonzero(np.diff(numbers, prepend=-1, append=-1))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if part is not None and part != numbers[a]:
                    if (made := close()) is not None:
                        yield made
                    keys, counts = [], []
                part = int(numbers[a])
                keys.append(key[a:b])
                counts.append(count[a:b])
        if keys and (made := close()) is not None:
            yield made
        if stats is None and written:
            yield pa.RecordBatch.from_arrays(longs(*np.array(written, np.int64).T), ["part", "n"])
        elif stats and (made := stats(None, None)) is not None:
            yield made

    return summed.mapInArrow(write, schema)


def _tokens(text: bytes) -> np.ndarray:
    return np.append(word_symbols(text.lower()).symbols, END)


def _counted(arrays: list[np.ndarray], bits: int) -> pa.RecordBatch:
    keys, counts = np.unique(np.concatenate(arrays), return_counts=True)
    parts = keys >> np.uint64(64 - bits)
    return pa.RecordBatch.from_arrays(longs(parts, keys, counts), ["part", "key", "c"])


def _count(training: DataFrame, keys_of, bits: int) -> DataFrame:
    """(part, key, c): the keys of all texts, counted chunk by chunk."""

    def compute(batches):
        waiting, size = [], 0
        for batch in batches:
            for found in keys_of([text for _, text in texts(batch)]):
                waiting.append(found)
                size += len(found)
                if size >= CHUNK:
                    yield _counted(waiting, bits)
                    waiting, size = [], 0
        if waiting:
            yield _counted(waiting, bits)

    return training.mapInArrow(compute, "part long, key long, c long")


@dataclass
class Model:
    """Where the arrays lie, and the numbers that hold for all of them."""

    folder: str
    word_bits: int
    pair_bits: int
    offsets: list[int]
    tokens: int = 0
    words: int = 0
    texts: int = 0
    pair_types: int = 0
    pair_discounts: tuple[float, ...] = (0.0, 0.5, 0.5, 0.5)
    word_discounts: tuple[float, ...] = (0.0, 0.5, 0.5, 0.5)
    word_types: tuple[int, ...] = (0, 0, 0)
    begin: tuple[int, ...] = (0, 0, 0)
    word_files: list[int] = field(default_factory=list)
    pair_files: list[int] = field(default_factory=list)


def discounts(n: list[int]) -> tuple[float, ...]:
    """Of counts 0, 1, 2 and more, from how many things occur 1, 2, 3 and 4 times."""
    if not all(n):
        return (0.0, 0.5, 0.5, 0.5)
    y = n[0] / (n[0] + 2 * n[1])
    return (0.0, *(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.0), k) for k in (1, 2, 3)))


class Lookup:
    """A model opened in a worker."""

    def __init__(self, model: Model):
        self.model = model
        self.vocabulary = SortedArrays(f"{model.folder}/words", model.word_bits, "<i8", model.word_files)
        self.pairs = SortedArrays(f"{model.folder}/pairs", model.pair_bits, "<u4", model.pair_files)
        self.offsets = np.array(model.offsets, np.int64)
        # While pairs are still being counted there are no statistics of words yet.
        ready = model.words and model.pair_types
        self.stats = np.memmap(f"{model.folder}/word-stats", "<u4", "r", 0, (model.words, 4)) if ready else np.zeros((1, 4), "<u4")

    def ids(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, training count) of every token."""
        distinct, back = np.unique(tokens, return_inverse=True)
        part, place, count = self.vocabulary.find(distinct)
        return np.where(place < 0, -1, self.offsets[part] + place)[back], count[back]


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first.astype(np.uint64) << np.uint64(32) | second.astype(np.uint64))


def with_previous(ids: np.ndarray, sizes: np.ndarray, begin: int) -> np.ndarray:
    """The token before each; ``begin`` before the first of every text."""
    previous = np.empty_like(ids)
    previous[1:] = ids[:-1]
    previous[np.cumsum(sizes) - sizes] = begin
    return previous


def train(training: DataFrame) -> Model:
    """Count a model over ``training`` (id, text)."""
    spark = training.sparkSession
    folder = mounted_folder(spark, "language-model")
    word_bits = 8
    files = staged(_write_ranges(_count(training, lambda found: map(_tokens, found), word_bits), f"{folder}/words", word_bits, "<i8"), "word-files")
    sizes = np.zeros(1 << word_bits, np.int64)
    for row in files.collect():  # one row per file, at most 2^word_bits
        sizes[row["part"]] = row["n"]
    model = Model(folder, word_bits, 6, (np.cumsum(sizes) - sizes).tolist(), words=int(sizes.sum()), word_files=np.flatnonzero(sizes).tolist())
    if model.words > MAX_WORDS:
        raise ValueError("the vocabulary has more words than 32-bit ids")
    model.tokens, model.texts = _totals(files, folder, word_bits)
    model.pair_bits = max(6, int(np.ceil(np.log2(max(model.tokens, 1) / RANGE_TOKENS))))

    def keys_of(found):
        tokens = [_tokens(text) for text in found]
        if tokens:
            lookup = Lookup(model)
            sizes = np.array(list(map(len, tokens)))
            ids, _ = lookup.ids(np.concatenate(tokens))
            yield pair_keys(with_previous(ids, sizes, model.words), ids)

    held: list[np.ndarray] = []

    def stats(keys, counts):
        """Rows (id, once, twice, more, second): of a chunk of files, and once more when called without keys."""
        if keys is not None:
            pair = _unmix(keys)
            kind = np.minimum(counts, 3)
            row = np.zeros((2, len(pair), 5), np.int64)
            row[0, :, 0], row[1, :, 0] = pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)
            row[0, np.arange(len(pair)), kind] = 1
            row[1, :, 4] = 1
            held.append(row.reshape(-1, 5))
            total = np.array([[-1, *(int((counts == n).sum()) for n in (1, 2, 3, 4))]])
            held.append(total)
        if not held or keys is not None and sum(map(len, held)) < CHUNK:
            return None
        rows = np.concatenate(held)
        held.clear()
        ids, at = np.unique(rows[:, 0], return_inverse=True)
        sums = [np.bincount(at, rows[:, i]).astype(np.int64) for i in range(1, 5)]
        return pa.RecordBatch.from_arrays(longs(ids, *sums), ["id", "once", "twice", "more", "second"])

    schema = "id long, once long, twice long, more long, second long"
    part = _write_ranges(_count(training, keys_of, model.pair_bits), f"{folder}/pairs", model.pair_bits, "<u4", stats, schema)
    part = staged(part, "pair-stats")
    words = part.groupBy("id").agg(*[F.sum(c).alias(c) for c in ("once", "twice", "more", "second")])
    words = staged(words, "word-stats")
    special = {r["id"]: r for r in words.where((F.col("id") == -1) | (F.col("id") == model.words)).collect()}
    if -1 in special:
        model.pair_discounts = discounts([special[-1][c] for c in ("once", "twice", "more", "second")])
    if model.words in special:
        model.begin = tuple(special[model.words][c] for c in ("once", "twice", "more"))
    ordinary = words.where((F.col("id") >= 0) & (F.col("id") < model.words))
    n = ordinary.agg(*[F.count_if(F.col("second") == k).alias(f"n{k}") for k in (1, 2, 3, 4)], F.sum("second").alias("types"), F.count_if(F.col("second") > 2).alias("more")).first()
    model.pair_types = n["types"] or 0
    model.word_discounts = discounts([n[f"n{k}"] for k in (1, 2, 3, 4)])
    model.word_types = (n["n1"], n["n2"], n["more"])
    _write_word_stats(ordinary, model)
    model.pair_files = _complete_files(f"{folder}/pairs", 12 * model.pair_types)
    return model


def _complete_files(folder: str, size: int) -> list[int]:
    """The numbers of the files in ``folder``, which must be of ``size`` together: else it is not one folder for all."""
    found = {int(entry.name): entry.stat().st_size for entry in os.scandir(folder) if entry.name.isdigit()}
    if sum(found.values()) != size:
        raise FileNotFoundError(f"{folder} holds {sum(found.values())} bytes of {size}: driver and executors must have it mounted")
    return sorted(found)


def _totals(files: DataFrame, folder: str, bits: int) -> tuple[int, int]:
    """Training tokens and texts: sums of the counts in the word files, and the count of the end token."""

    def total(batches):
        lookup = SortedArrays(f"{folder}/words", bits, "<i8")
        for batch in batches:
            sums = [int(lookup.part(number)[1].sum()) for number in batch.column("part").to_pylist()]
            ends = [int(lookup.find(np.array([END]))[2][0]) if number == int(END) >> 64 - bits else 0 for number in batch.column("part").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int64()), pa.array(ends, pa.int64())], ["tokens", "texts"])

    row = files.mapInArrow(total, "tokens long, texts long").agg(F.sum("tokens").alias("tokens"), F.sum("texts").alias("texts")).first()
    return row["tokens"] or 0, row["texts"] or 0


def _write_word_stats(words: DataFrame, model: Model) -> None:
    """One file of four numbers per word id; tasks fill disjoint stretches of it."""
    path = f"{model.folder}/word-stats"
    with open(path, "wb") as out:
        out.truncate(model.words * 16)

    def write(batches):
        done = 0
        with open(path, "r+b") as out:
            for batch in batches:
                ids = batch.column("id").to_numpy()
                rows = _narrowed(np.stack([batch.column(c).to_numpy() for c in ("once", "twice", "more", "second")], axis=1), "<u4")
                edges = np.flatnonzero(np.diff(ids, prepend=-2, append=-2) != 1)
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    os.pwrite(out.fileno(), rows[a:b].tobytes(), int(ids[a]) * 16)
                done += len(ids)
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["n"])

    stretch = F.shiftright("id", 14)
    sorted_words = words.repartition(stretch).sortWithinPartitions("id")
    sorted_words.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def token_scores(lookup: Lookup, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log10 probability by the model, log10 of the add-one base, known) of every token of texts of ``sizes``."""
    m = lookup.model
    ids, counts = lookup.ids(tokens)
    known = ids >= 0
    safe = np.where(known, ids, 0)
    second = np.where(known, lookup.stats[safe, 3], 0)
    total = max(m.pair_types, 1)
    spare = sum(d * n for d, n in zip(m.word_discounts[1:], m.word_types, strict=True)) / total if m.pair_types else 1.0
    lower = np.maximum(second - np.array(m.word_discounts)[np.minimum(second, 3)], 0) / total + spare / (m.words + 1)

    previous = with_previous(ids, sizes, m.words)
    times = with_previous(counts, sizes, m.texts)  # how often the token before occurs, that is, begins a pair
    begin = previous == m.words
    of = np.where((previous >= 0) & ~begin, previous, 0)
    kinds = np.where(begin[:, None], np.array(m.begin), lookup.stats[of, :3]) @ np.array(m.pair_discounts[1:])
    seen = np.zeros(len(ids), np.int64)
    asked = known & (previous >= 0) & (times > 0)
    distinct, back = np.unique(pair_keys(previous[asked], ids[asked]), return_inverse=True)
    seen[asked] = lookup.pairs.find(distinct)[2][back]
    times = np.where(previous >= 0, times, 0)
    share = np.maximum(times, 1)
    higher = np.maximum(seen - np.array(m.pair_discounts)[np.minimum(seen, 3)], 0) / share + kinds / share * lower
    probability = np.where(times > 0, higher, lower)
    base = (counts + 1) / (m.tokens + m.words + 1)
    return np.log10(probability), np.log10(base), known


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score, perplexity) of every whole text."""
    described = json.dumps(asdict(model))

    def compute(batches):
        lookup = Lookup(Model(**json.loads(described)))
        for batch in batches:
            rows, waiting, size = [], [], 0

            def flush():
                sizes = np.array(list(map(len, waiting)))
                columns = token_scores(lookup, np.concatenate(waiting), sizes)
                starts = np.cumsum(sizes) - sizes
                high, base, known = (np.add.reduceat(c.astype(float), starts) for c in columns)
                rows.extend(zip(sizes.tolist(), known.astype(int).tolist(), base.tolist(), high.tolist(), strict=True))

            for _, text in texts(batch):
                waiting.append(_tokens(text))
                size += len(waiting[-1])
                if size >= CHUNK // 4:
                    flush()
                    waiting, size = [], 0
            if waiting:
                flush()
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n_tokens", "n_known", "base_score", "score"])

    source = id_and_text(docs, id_col, text_col)
    kind = source.schema["id"].dataType.simpleString()
    scored = source.mapInArrow(compute, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def train_and_score(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Model]:
    """Scores of ``docs`` by a model of ``training``."""
    model = train(id_and_text(training, id_col, text_col))
    return score(docs, model, id_col, text_col), model
