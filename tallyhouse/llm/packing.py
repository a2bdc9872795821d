"""Packing documents into sequences of fixed length by minimum bin slack.

Every task packs the documents it reads, window by window, so nothing is shuffled and memory is
bounded by one window of token ids. For each sequence a bitset holds the sums that the remaining
lengths can reach, longest first; the multiset that comes closest to the capacity is found by
walking back through the bitsets and counting how often each length was taken. Documents longer
than a sequence are cut, and where no multiset fills a sequence exactly one more document is cut
to close the slack, so sequences have no padding. What is left at the end of a task, less than
one sequence, goes into sequences whose lengths are powers of two, which need none either.

Defined results: a null or empty text is a document of its end token alone; repeated rows are
packed once each; an empty table gives no pieces. Which documents share a sequence depends on how
the input is split into tasks; for one split it is always the same.
"""

from __future__ import annotations

import struct
from bisect import insort
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyhouse.llm.common import id_and_text, texts

WINDOW_TOKENS = 1 << 21
CACHED_WORDS, CACHED_STEMS = 500_000, 1_000_000
PUNCTUATION = b".,;:!?"


class WordIds(dict):
    """Word → its ids as little-endian 32-bit numbers, computed once per word and worker.

    Byte-pair merges never cross white space, so the ids of a text are those of its words in a row.
    For plain Latin-1 words the model is asked directly, with the punctuation at the end as a word
    of its own, as the tokenizer's pattern splits them; any other word takes the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.stems: dict[bytes, bytes] = {}
        self.tails: dict[bytes, bytes] = {}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        # The byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on.
        self.alphabet = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(PUNCTUATION)
        lowered = stem.lower()
        ids = self.stems.get(lowered)
        if ids is None:
            plain = lowered.decode()
            if not plain.isalpha() or max(plain) > "\xff":
                ids = self[word] = self._whole(word)
                return ids
            tokens = self.model.tokenize(plain.lower().encode().decode("latin1").translate(self.alphabet))
            ids = self.stems[lowered] = self._packed([token.id for token in tokens])
        if len(stem) < len(word):
            tail = word[len(stem) :]
            if tail not in self.tails:
                self.tails[tail] = self._whole(tail)
            ids += self.tails[tail]
        self[word] = ids
        return ids

    def _whole(self, word: bytes) -> bytes:
        return self._packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def trim(self) -> None:
        if len(self) > CACHED_WORDS:
            self.clear()
        if len(self.stems) > CACHED_STEMS:
            self.stems.clear()
        if len(self.tails) > CACHED_WORDS:
            self.tails.clear()

    def of_text(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


def closest_fill(lengths: list[int], counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How often to take each length so that the sum comes closest to, and not above, ``capacity``.

    ``lengths`` ascend. Bit s of a bitset is set if the lengths so far can sum to s; a length with
    count c is shifted in by 1, 2, 4, … copies up to c.
    """
    within = (1 << capacity + 1) - 1
    reach, steps = 1, []
    for length in reversed(lengths):
        if length > capacity:
            continue
        left = most = min(counts[length], capacity // length)
        steps.append((length, most, reach))
        copies = 1
        while left:
            copies = min(copies, left)
            reach |= reach << length * copies & within
            left -= copies
            copies *= 2
        if reach >> capacity & 1:
            break
    taken, total = {}, reach.bit_length() - 1
    for length, most, before in reversed(steps):
        for copies in range(most + 1):
            if before >> total - copies * length & 1:
                break
        if copies:
            taken[length] = copies
            total -= copies * length
    return taken


class _Window:
    """Pieces waiting to be packed, by length. A piece is (document, start, length)."""

    def __init__(self, capacity: int):
        self.capacity, self.total = capacity, 0
        self.lengths: list[int] = []
        self.waiting: dict[int, list[tuple]] = defaultdict(list)

    def add(self, piece: tuple) -> None:
        if not self.waiting[piece[2]]:
            insort(self.lengths, piece[2])
        self.waiting[piece[2]].append(piece)
        self.total += piece[2]

    def take(self, length: int) -> tuple:
        piece = self.waiting[length].pop()
        if not self.waiting[length]:
            del self.waiting[length]
            self.lengths.remove(length)
        self.total -= length
        return piece

    def fill(self, capacity: int) -> list[tuple]:
        """One sequence of exactly ``capacity`` ids, which must be waiting."""
        counts = {length: len(pieces) for length, pieces in self.waiting.items()}
        sequence = [self.take(n) for n, k in closest_fill(self.lengths, counts, capacity).items() for _ in range(k)]
        slack = capacity - sum(piece[2] for piece in sequence)
        if slack:  # every piece still waiting is longer than that
            document, start, length = self.take(self.lengths[-1])
            sequence.append((document, start, slack))
            self.add((document, start + slack, length - slack))
        return sequence

    def sequences(self, last: bool) -> Iterator[list[tuple]]:
        keep = 0 if last else WINDOW_TOKENS // 4  # a choice of lengths stays for the next window
        while self.total >= max(self.capacity, keep):
            yield self.fill(self.capacity)
        while last and self.total:
            yield self.fill(1 << self.total.bit_length() - 1)


PIECES = "id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: its document, place there, ids, and place in its sequence.

    ``tokenizer_path`` must be readable by every worker. A sequence is the pieces of one
    ``sequence_id`` by ``offset``; it is ``capacity`` long or a power of two.
    """
    if capacity < 1:
        raise ValueError("a sequence holds at least one token")
    source = id_and_text(docs, id_col, text_col)
    schema = PIECES.format(kind=source.schema["id"].dataType.simpleString())
    end = end_id.to_bytes(4, "little")

    def pack_task(batches):
        words = WordIds(tokenizer_path)
        window, numbers = _Window(capacity), [TaskContext.get().partitionId() << 32]
        names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        kind = None

        def rows(sequences):
            out = []
            for sequence in sequences:
                offset = 0
                for document, start, length in sequence:
                    key, ids = document
                    out.append((key, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4, numbers[0], offset))
                    offset += length
                numbers[0] += 1
                if len(out) >= 4096:
                    yield record(out)
                    out = []
            if out:
                yield record(out)

        def record(out):
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

        def long_pieces(document, tokens):
            for start in range(0, tokens - capacity + 1, capacity):
                yield [(document, start, capacity)]

        for batch in batches:
            kind = batch.schema.field("id").type
            for key, text in texts(batch):
                ids = words.of_text(text) + end
                words.trim()
                tokens = len(ids) // 4
                yield from rows(long_pieces((key, ids), tokens))
                if tokens % capacity:
                    window.add(((key, ids), tokens - tokens % capacity, tokens % capacity))
                if window.total >= WINDOW_TOKENS:
                    yield from rows(window.sequences(last=False))
        yield from rows(window.sequences(last=True))

    return source.mapInArrow(pack_task, schema)
