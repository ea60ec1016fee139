"""Words of many texts at once, as numpy arrays over UTF-8 bytes.

A text column of an Arrow batch is one byte buffer with offsets. Word characters are told by
single bytes: every byte of a non-ASCII character is 0x80 or above, so classes that take all
non-ASCII characters, or none, need no decoding. Nothing here loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20  # texts are taken in chunks of about so many bytes, a long one alone




def _table(separators: list[tuple[int, int]]) -> np.ndarray:
    out = np.ones(256, bool)
    for low, high in separators:
        out[low : high + 1] = False
    return out


#: ``[^\x20\x09-\x0D]+``
SPACED = _table([(0x20, 0x20), (0x09, 0x0D)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z
ALPHANUMERIC = _table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def randoms(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    step = np.uint64(0x9E3779B97F4A7C15)
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * step)


_BYTES = randoms(256, 1)
_places = randoms(1 << 12, 2) | np.uint64(1)


def _place_weights(n: int) -> np.ndarray:
    global _places
    if n > len(_places):
        _places = randoms(n, 2) | np.uint64(1)
    return _places


@dataclass
class Chunk:
    """Texts ``first .. first + len(starts) - 2`` of a batch: bytes and the bounds of each text."""

    first: int
    data: np.ndarray
    starts: np.ndarray  # one more than there are texts

    def __len__(self) -> int:
        return len(self.starts) - 1


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(starts, starts[at] + size, "right")) - 1
        end = min(len(column), max(at + 1, end))
        yield Chunk(at, data[starts[at] : starts[end]], starts[at : end + 1] - starts[at])
        at = end


@dataclass
class Words:
    """Words of a chunk: bounds in its bytes, and for each text the range of its words."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: a random multilinear form of its bytes, scrambled."""
        length = self.end - self.start
        if not len(length):
            return np.zeros(0, np.uint64)
        first = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(first, length)
        byte = self.data[place + np.repeat(self.start, length)]
        weights = _place_weights(int(length.max()))
        sums = np.add.reduceat(_BYTES[byte] * weights[place], first)
        return mix(sums + length.astype(np.uint64))


def words(chunk: Chunk, kind: np.ndarray, lower: bool = True) -> Words:
    data = LOWER[chunk.data] if lower else chunk.data
    inside = kind[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    if len(data):
        opens = chunk.starts[:-1]
        before[opens[opens < len(data)]] = False
        closes = chunk.starts[1:] - 1
        after[closes[closes >= 0]] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, chunk.starts))


_STEPS = randoms(64, 3) | np.uint64(1)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each word on; the last ``k - 1`` places are left out.

    Places whose words run into the next text are the caller's to mask.
    """
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total += hashes[i : i + n] * _STEPS[i]
    return mix(total + np.uint64(k))
