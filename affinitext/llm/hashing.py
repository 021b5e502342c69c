"""Fingerprints of byte ranges and word shingles for many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MASK = 2**64 - 1
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
#: Bytes of texts worked on together; a longer text is worked on alone.
CHUNK_BYTES = 1 << 20

_bytes = np.random.default_rng(20240229).integers(0, 2**64, (2, 256), dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """BASE**i and BASE**-i for i up to n, modulo 2**64, kept for the next call."""
    if not _powers or len(_powers[0]) < n + 1:
        size = max(n, CHUNK_BYTES) + 1
        made = []
        for base in (BASE, INVERSE):
            factor = np.full(size, base, dtype=np.uint64)
            factor[0] = 1
            made.append(np.cumprod(factor))
        if n > 8 * CHUNK_BYTES:
            return made
        _powers[:] = made
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of h."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Prints:
    """Fingerprints of any ranges of one byte buffer."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        up, self.down = powers(len(data))[:2]
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_bytes[seed][data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def all_of(self, length: int) -> np.ndarray:
        """Of every range of that length."""
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and row offsets of runs of rows; null texts have no bytes."""
    texts = texts.cast(pa.large_binary())
    lengths = texts.fill_null(b"")
    offsets = np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset :][: len(lengths) + 1]
    values = lengths.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(lengths):
        last = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        last = min(max(last, row + 1), len(lengths))
        part = offsets[row : last + 1]
        yield row, data[part[0] : part[-1]], part - part[0]
        row = last


_is_word = np.ones(256, bool)
_is_word[[0x20, *range(0x09, 0x0E)]] = False
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
FACTOR = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct fingerprints of each text's word shingles.

    A text of fewer words has one shingle, all its words; one without words has none.
    """
    for _, data, offsets in chunks(texts):
        word = _is_word[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.concatenate([[False], word[:-1]]) if len(data) else word
        after = np.concatenate([word[1:], [False]]) if len(data) else word
        start = np.flatnonzero(word & (~before | edge[:-1]))
        end = np.flatnonzero(word & (~after | edge[1:])) + 1
        prints = Prints(_lower[data]).of(start, end)
        first = np.searchsorted(start, offsets)
        joined = prints[: max(len(prints) - width + 1, 0)].copy()
        for k in range(1, width):
            joined = joined * FACTOR + prints[k : k + len(joined)]
        joined = mixed(joined)
        for a, b in zip(first, first[1:], strict=False):
            if b - a >= width:
                yield np.unique(joined[a : b - width + 1])
            elif b > a:
                short = 0
                for h in prints[a:b].tolist():
                    short = (short * int(FACTOR) + h + 1) & MASK
                yield mixed(np.array([short ^ int(b - a)], dtype=np.uint64))
            else:
                yield np.zeros(0, np.uint64)
