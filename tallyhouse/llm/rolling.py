"""Rolling fingerprints of symbol sequences, and runs of windows around shared anchors.

A fingerprint modulo 2^64 alone can be cheated: sequences of two symbols that alternate like those of
Thue and Morse differ by a multiple of a high power of two, whatever the base, so pairs of symbols
with equal low bits give unequal sequences of one fingerprint. Whoever decides by fingerprints
therefore draws the symbols anew for each run (``repeats.Symbols``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15 - 2  # odd, and 3 modulo 8: equal symbols at different places do not cancel
SEGMENT = 1 << 20
_PLACE = np.uint64((1 << 22) - 1)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


class Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            factors = np.repeat(np.array([[BASE], [pow(BASE, -1, 1 << 64)]], np.uint64), size, axis=1)
            factors[:, 0] = 1
            self.up, self.down = np.cumprod(factors, axis=1, dtype=np.uint64)
        return self.up, self.down


POWERS = Powers()


class Rolling:
    """Fingerprints of any stretch of a sequence of symbol hashes."""

    def __init__(self, symbols: np.ndarray):
        up, self.down = POWERS.upto(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * up[: len(symbols)], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.down[start]

    def all(self, length: int) -> np.ndarray:
        """Of every stretch of ``length`` symbols."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.down[:n] if n > 0 else np.empty(0, np.uint64)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours (van Herk: minima forwards and backwards in blocks)."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forwards = np.minimum.accumulate(blocks, axis=1).ravel()
    backwards = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backwards[: n - width + 1], forwards[width - 1 : n])


def anchors(rolling: Rolling, gram: int, width: int) -> np.ndarray:
    """For each start the place, from there on, of the least of ``width`` grams; the first of equals.

    It depends on nothing but the ``width + gram - 1`` symbols from the start on, so equal windows
    have their anchors at equal places.
    """
    grams = mix(rolling.all(gram))
    if len(grams) < width:
        return np.empty(0, np.int64)
    places = np.arange(len(grams), dtype=np.uint64)
    return (sliding_minimum(grams & ~_PLACE | places, width) & _PLACE).astype(np.int64)


def segments(symbols: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, symbols) of overlapping parts, so that every window start lies in exactly one."""
    for at in range(0, max(len(symbols) - window + 1, 0), SEGMENT):
        yield at, symbols[at : at + SEGMENT + window - 1]


def covered(rolling: Rolling, start: np.ndarray, count: np.ndarray, shift: np.ndarray, window: int) -> np.ndarray:
    """Name of all that ``count`` windows from ``start`` on cover, and of their places about the anchor."""
    shape = ((shift + (1 << 24)) << 26 | count).astype(np.uint64)
    return mix(rolling.of(start, count + (window - 1)) + mix(shape))


def window_runs(symbols: np.ndarray, window: int, gram: int, width: int) -> tuple[np.ndarray, ...]:
    """Starts of all windows, gathered into runs with one anchor: (core, full, start, count, shift).

    All windows of a run hold the ``window - width + 1`` symbols from the anchor on, whose
    fingerprint is ``core``. ``full`` stands for everything the run covers and the anchor's place
    in it: runs with equal ``full`` have equal windows throughout. Two equal windows always lie in
    runs with equal ``core``, at equal distances from the anchor, which lies ``shift`` after the start.
    """
    parts = []
    for at, part in segments(symbols, window):
        rolling = Rolling(part)
        n = len(part) - window + 1
        anchor = anchors(rolling, gram, width)[:n]
        start = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        count = np.diff(np.append(start, n))
        shift = anchor[start] - start
        core = mix(rolling.of(anchor[start], window - width + 1))
        full = covered(rolling, start, count, shift, window)
        parts.append((core, full, start + at, count, shift))
    if not parts:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))
