"""Words and their hashes for many texts at once, over the bytes of an Arrow string column.

A word is a run of bytes other than space and 0x09-0x0D; since these never occur inside a longer UTF-8
character, that is the same as on code points. A-Z count as a-z if wanted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A published 64-bit finaliser (splitmix64): every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
    if lower:
        values[65:91] = values[97:123]
    values[_SPACE] = 0
    return values


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}


@dataclass(frozen=True)
class Words:
    """Hashes of all words in order; words of row i are ``hashes[first[i]:first[i + 1]]``. ``stems``: of their first bytes."""

    hashes: np.ndarray
    first: np.ndarray
    stems: np.ndarray | None = None

    def row(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]


def _word_hashes(data: np.ndarray, starts_row: np.ndarray, lower: bool, stem: int) -> tuple[np.ndarray, ...]:
    """(positions at which words start, their hashes, their stems' hashes) of one buffer; ``starts_row``: where rows begin."""
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    rows = starts_row[starts_row < len(data)]
    begins[rows] = inside[rows]
    at = np.flatnonzero(begins)
    if not len(at):
        return at, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    within = np.arange(len(data), dtype=np.int64)
    within -= np.repeat(np.concatenate([[0], at]), np.diff(np.concatenate([[0], at, [len(data)]])))
    # White space has the value 0 and may follow a word in its stretch: it adds nothing but a longer table.
    powers = np.cumprod(np.full(int(within.max()) + 1, GOLDEN, np.uint64))
    parts = _VALUES[lower][data] * powers[within]
    hashes = mix(np.add.reduceat(parts, at))
    if not stem:
        return at, hashes, hashes[:0]
    parts[within >= stem] = 0
    return at, hashes, mix(np.add.reduceat(parts, at) + GOLDEN)


def words_of(texts: pa.Array, lower: bool = True, stem: int = 0) -> Words:
    """Words of a string column without nulls, with the hashes of their first ``stem`` bytes if wanted."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data is not None else np.zeros(0, np.uint8)
    edges = edges - edges[0]
    at, hashes, stems = _word_hashes(data, edges[:-1], lower, stem)
    return Words(hashes, np.searchsorted(at, edges), stems if stem else None)


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its runs of ``size`` words.

    With fewer words the whole sequence is the one shingle; without words the set is empty.
    """
    hashes = words.hashes
    count = max(0, len(hashes) - size + 1)
    runs = np.zeros(count, np.uint64)
    for k in range(size):
        runs = runs * GOLDEN + hashes[k : k + count]
    runs = mix(runs)
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if high - low >= size:
            yield np.unique(runs[low : high - size + 1])
        elif high > low:
            whole = np.uint64(high - low)
            with np.errstate(over="ignore"):
                for h in hashes[low:high]:
                    whole = whole * GOLDEN + h
            yield mix(np.array([whole], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
