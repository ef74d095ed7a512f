"""Words and word shingles of Arrow string columns as numpy arrays, without a Python loop per word.

A word is a maximal run without ASCII white space. Words are hashed by a polynomial over a random
value per byte, A-Z folded into a-z unless told otherwise; everything is a function of the bytes
alone, so each task of each run computes the same numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PART_BYTES = 512 << 10  # text at once: what a worker frees between tasks mostly stays with its process
BLOCK_BYTES = 128 << 10  # bytes hashed at once; the numbers for them take some forty times as much

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_ALNUM = np.array([not (chr(b).isalnum() or b > 127) for b in range(256)])


def _values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64)


_EXACT = _values(7)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _EXACT[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        factors = np.full(max(n, BLOCK_BYTES + 4096), base, np.uint64)
        factors[0] = 1
        known = _powers[int(base)] = np.cumprod(factors, dtype=np.uint64)
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others; a bijection."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


@dataclass
class Part:
    """Rows ``first`` ... of a column: their bytes, and where each row begins and ends there."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def parts(column: pa.Array, limit: int = PART_BYTES) -> Iterator[Part]:
    """Cut a string column into runs of rows of at most ``limit`` bytes, or one longer row each.
    Null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield Part(
            low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        )
        low = high


@dataclass
class Words:
    """Words of all rows of a part in order; ``rows[i]:rows[i + 1]`` are those of row i."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def words(
    part: Part, fold: bool = True, gaps: np.ndarray = SPACE, cuts: np.ndarray | None = None
) -> Words:
    """The words of a part; ``gaps`` marks the bytes between words, ``cuts`` the places of a part
    where a word ends and the next one begins at once."""
    table = _FOLDED if fold else _EXACT
    data, size = part.data, len(part.data)
    edge = np.zeros(size + 1, bool)
    edge[part.offsets] = True
    if cuts is not None:
        edge[:size] |= cuts
    solid = ~np.frombuffer(data.tobytes().translate(gaps.tobytes()), bool)
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:size]
    last = solid
    last[:-1] &= ~solid[1:] | edge[1:size]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + BLOCK_BYTES, "right")))
        begin, stop = starts[low], ends[high - 1]
        sums = np.zeros(stop - begin + 1, np.uint64)
        terms = table.take(data[begin:stop])
        terms *= powers(_BASE, stop - begin)
        np.cumsum(terms, out=sums[1:])
        at, to = starts[low:high] - begin, ends[low:high] - begin
        own = (sums[to] - sums[at]) * powers(_UNBASE, stop - begin)[at]
        hashes[low:high] = mix(own + (to - at).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        low = high
    return Words(starts, ends, hashes, np.searchsorted(starts, part.offsets))


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k neighbours, over row borders too; k - 1 fewer than hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total *= np.uint64(0xA24BAED4963EE407)
        total += hashes[i : i + n]
    return mix(total)


def shingle_sets(found: Words, k: int = 5) -> list[np.ndarray]:
    """For each row the sorted different hashes of its k-word runs; of the whole row if it has
    fewer words; nothing if it has none."""
    every, sets = runs(found.hashes, k), []
    for a, b in zip(found.rows[:-1].tolist(), found.rows[1:].tolist()):
        if b - a >= k:
            own = np.sort(every[a : b - k + 1])
            sets.append(own[np.append(True, own[1:] != own[:-1])])
        elif b > a:
            sets.append(runs(found.hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
