"""Texts of an Arrow batch as flat bytes, and the words in them, with NumPy.

Every function works on bounded slices of a batch, so that memory follows the
slice (or one long text), not the batch. Words are runs of bytes other than
``\\x20`` and ``\\x09``-``\\x0D``; as UTF-8 uses no such byte inside a character,
these are the words of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SEED = 0x9E3779B97F4A7C15
MULTIPLIER = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(MULTIPLIER, -1, 1 << 64)

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_slices(
    column: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, starts) of consecutive rows.

    A slice holds at most ``limit`` bytes, or one longer text. ``starts`` has
    the place of each row's bytes and the end of the last. A null text is empty.
    """
    filled = column.fill_null("").cast(pa.large_string())
    _, offsets, data = filled.buffers()
    places = np.frombuffer(offsets, dtype=np.int64)[filled.offset:filled.offset + len(filled) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row, rows = 0, len(filled)
    while row < rows:
        end = max(row + 1, int(np.searchsorted(places, places[row] + limit, "right")) - 1)
        yield row, end, flat[places[row]:places[end]], places[row:end + 1] - places[row]
        row = end


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers and those of its inverse, from exponent 0."""
    tables = []
    for base in (MULTIPLIER, INVERSE):
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        tables.append(np.multiply.accumulate(table))
    return tables[0], tables[1]


def words(
    data: np.ndarray, starts: np.ndarray, prefix: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word (64 bits), its row in the slice, and word counts by row.

    With ``prefix`` only that many first bytes of a word count.
    """
    rows = len(starts) - 1
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(rows, np.int64)
    solid = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a text begins here
    edge[starts] = True
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = False, solid[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = False, solid[1:]
    first = np.flatnonzero(solid & (~before | edge[:-1]))
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    if prefix is not None:
        end = np.minimum(end, first + prefix)
    power, inverse = _powers(max(SLICE_BYTES, 1 << int(len(data)).bit_length()))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=total[1:])
    hashes = mix((total[end] - total[first]) * inverse[first])
    row = np.searchsorted(starts, first, "right") - 1
    return hashes, row, np.bincount(row, minlength=rows)


def shingles(hashes: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``width`` words within a row."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = row[:count] == row[width - 1:]
    joined = hashes[:count]
    for place in range(1, width):
        joined = mix(joined * np.uint64(MULTIPLIER) + hashes[place:place + count])
    return joined[whole], row[:count][whole]
