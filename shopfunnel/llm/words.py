"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a maximal run of bytes other than space and 0x09-0x0D. Texts are cut into chunks of
whole texts, so that working arrays stay small; a text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed at a time.
CHUNK_BYTES = 1 << 20

_FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_FACTOR, -1, 1 << 64)

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: Words without signs: ASCII letters and digits, and all beyond ASCII.
_IS_PLAIN = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_BYTE_VALUES = np.random.default_rng(0x5EED).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER_VALUES = _BYTE_VALUES.copy()
_LOWER_VALUES[ord("A") : ord("Z") + 1] = _BYTE_VALUES[ord("a") : ord("z") + 1]


class _Powers:
    """Powers of the factor and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, CHUNK_BYTES + 1)
            self.up, self.down = (self._table(x, size) for x in (_FACTOR, _INVERSE))
        return self.up, self.down

    @staticmethod
    def _table(base: int, size: int) -> np.ndarray:
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words(NamedTuple):
    """Hashes of the words of consecutive texts; text i has ``hashes[bounds[i]:bounds[i + 1]]``.

    ``starts`` and ``ends`` are the words' places in ``data``.
    """

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and the n + 1 places where texts begin. Null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` bytes together, or one text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False, plain: bool = False) -> Words:
    """Words of the texts in ``data``; ``lower`` folds A-Z, ``plain`` takes ASCII signs as gaps."""
    n = len(data)
    word = (_IS_PLAIN if plain else _IS_WORD)[data]
    before = np.empty(n, dtype=bool)
    before[1:] = word[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.empty(n, dtype=bool)
    after[:-1] = word[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    up, down = _POWERS.upto(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_LOWER_VALUES if lower else _BYTE_VALUES)[data] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends, data)


def hashes_of(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hashes of stretches of bytes that follow each other, the last ending at ``places[-1]``."""
    n = len(data)
    up, down = _POWERS.upto(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:n], out=sums[1:])
    return mix((sums[places[1:]] - sums[places[:-1]]) * down[places[:-1]])


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; run i begins at word i, across text bounds too."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    up, down = _POWERS.upto(len(hashes))
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[:count] + np.uint64(n))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values."""
    if len(values) < width:
        return values[:0]
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def text_chunks(
    column: pa.Array, lower: bool = False, plain: bool = False, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, Words]]:
    """The words of a column, chunk by chunk, with the range of rows each chunk covers."""
    data, offsets = utf8(column)
    for first, last in chunks(offsets, limit):
        at = offsets[first : last + 1]
        yield first, last, words_of(data[at[0] : at[-1]], at - at[0], lower, plain)
