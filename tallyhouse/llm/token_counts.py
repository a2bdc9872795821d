"""Numbers of word pieces per text, by a linear longest-match automaton.

The pieces form a trie over characters. Every node also knows what happens when the next
character does not fit: ``fail`` is the node to go on from and ``popped`` the number of pieces
that are complete by then. A word is read once from left to right and its greedy longest-match
pieces are counted without being built (Song et al., "Fast WordPiece Tokenization", 2021).
The automaton is sent to the workers; its size is bounded by the vocabulary.

Defined results: a null or empty text has no words and no pieces; a word that has no greedy
segmentation counts as one piece and as unknown. Words are separated by ASCII white space.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.common import id_and_text, texts

WORD_START = "▁"
CACHED_WORDS = 400_000


@dataclass
class LongestMatch:
    """``step`` maps node << 21 | code point to the next node; node 0 is the root."""

    step: dict[int, int]
    fail: list[int]
    popped: list[int]
    start: str = WORD_START

    def count(self, word: str) -> int:
        """Number of pieces of a word; 0 if it has no greedy segmentation."""
        node = pieces = 0
        for char in map(ord, self.start + word):
            while (following := self.step.get(node << 21 | char)) is None:
                if self.fail[node] < 0:
                    return 0
                pieces += self.popped[node]
                node = self.fail[node]
            node = following
        while node:
            if self.fail[node] < 0:
                return 0
            pieces += self.popped[node]
            node = self.fail[node]
        return pieces


def build_automaton(pieces: Iterable[str], start: str = WORD_START) -> LongestMatch:
    """``start`` is put before every word, so that pieces which begin with it match only there."""
    step: dict[int, int] = {}
    ends = [False]
    for piece in pieces:
        node = 0
        for char in map(ord, piece):
            key = node << 21 | char
            if key not in step:
                step[key] = len(ends)
                ends.append(False)
            node = step[key]
        ends[node] = bool(node)
    children: list[list[tuple[int, int]]] = [[] for _ in ends]
    for key, node in step.items():
        children[key >> 21].append((key & 0x1FFFFF, node))
    fail, popped = [-1] * len(ends), [0] * len(ends)
    queue = deque([0])
    while queue:
        parent = queue.popleft()
        for char, node in children[parent]:
            queue.append(node)
            if ends[node]:
                fail[node], popped[node] = 0, 1
                continue
            at, count = fail[parent], popped[parent]
            while at >= 0 and (at << 21 | char) not in step:
                count += popped[at]
                at = fail[at]
            if at >= 0:
                fail[node], popped[node] = step[at << 21 | char], count
    return LongestMatch(step, fail, popped, start)


def sentencepiece_vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not special(i)]


class _Counts(dict):
    """Word → pieces, filled on demand; emptied between texts when it has grown large."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        found = self[word] = self.automaton.count(word.decode())
        return found


def count_tokens(docs: DataFrame, pieces: Iterable[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens, n_unknown) of every whole text."""
    automaton = docs.sparkSession.sparkContext.broadcast(build_automaton(pieces))

    def count(batches):
        counts = _Counts(automaton.value)
        for batch in batches:
            rows = []
            for key, text in texts(batch):
                found = list(map(counts.__getitem__, text.split()))
                unknown = found.count(0)
                rows.append((len(found), sum(found) + unknown, unknown))
                if len(counts) > CACHED_WORDS:
                    counts.clear()
            columns = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n_words", "n_tokens", "n_unknown"])

    source = id_and_text(docs, id_col, text_col)
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(count, f"id {kind}, n_words long, n_tokens long, n_unknown long")
