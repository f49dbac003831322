"""Words of many texts at once, as 64-bit hashes, found on the UTF-8 bytes with numpy.

A tokenisation is a table over the 256 byte values: 0 ends a word, any other
value is the byte that counts (so A-Z can stand for a-z, and 255, which UTF-8
does not use, for NUL). The hash of a word is
a polynomial over its bytes, taken from one running sum per block of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def byte_table(is_word) -> np.ndarray:
    """Table for the bytes that ``is_word`` takes, upper-case ASCII read as lower case."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        if is_word(low):
            table[b] = low or 255
    return table


#: Letters, digits and every byte of a non-ASCII character.
WORDS = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
#: Everything but white space.
CHUNKS = byte_table(lambda b: b != 32 and not 9 <= b <= 13)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers


@dataclass
class Words:
    """Words of a batch: hash, first and last byte; ``first[i]:first[i + 1]`` are those of text i."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    low: np.ndarray

    def text(self, a: int, b: int) -> list[str]:
        return [self.low[s:e].tobytes().decode() for s, e in zip(self.start[a:b], self.end[a:b], strict=True)]


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def find_words(texts: pa.Array, table: np.ndarray = WORDS) -> Words:
    data, offsets = bytes_of(texts)
    low = table[data]
    inside = low != 0
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    start[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(hash_runs(low, starts, ends), starts, ends, np.searchsorted(starts, offsets), low)


def hash_runs(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes; runs are in order and do not overlap."""
    hashes = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + BLOCK, "right")))
        origin, stop = starts[a], ends[b - 1]
        power, inverse = _power_tables(int(stop - origin))
        block = low[origin:stop]
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_VALUES[block] * power[: len(block)], out=sums[1:])
        s = starts[a:b] - origin
        hashes[a:b] = (sums[ends[a:b] - origin] - sums[s]) * inverse[s]
        a = b
    return mix(hashes)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; positions near the end have none."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + words[j : j + n]
    return mix(out)


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``most`` bytes together, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths, dtype=np.int64)
    a = 0
    while a < len(total):
        before = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, before + most, "right")))
        yield batch.slice(a, b - a)
        a = b
