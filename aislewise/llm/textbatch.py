"""Text columns of Arrow batches as numpy arrays: bounded slices, words and their hashes.

Words are runs of bytes other than ASCII white space (0x20, 0x09-0x0D). Hashes are 64 bits:
a polynomial over random byte values, mixed with the length. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20140301).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + 1)
        for base, name in ((_BASE, "_powers"), (_INVERSE, "_inverses")):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
        if n > 4 * SLICE_BYTES:  # one very long text: the tables are not kept
            big = _powers, _inverses
            _powers = _inverses = np.ones(1, np.uint64)
            return big
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    ordered = np.sort(values)
    if len(ordered) == 0:
        return ordered
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return ordered[first]


@dataclass
class Texts:
    """Rows of one slice: row i is ``data[offsets[i]:offsets[i + 1]]``, UTF-8."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Texts:
        return Texts(LOWER[self.data], self.offsets)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        powers, inverses = _power_tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[self.data] * powers[: len(self.data)], out=sums[1:])
        value = (sums[ends] - sums[starts]) * inverses[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def count_in_rows(self, flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return np.diff(sums[self.offsets])


@dataclass
class Words:
    """Words of a slice in order; those of row i are at ``rows[i]:rows[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def row_of_each(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def find_runs(texts: Texts, inside: np.ndarray) -> Words:
    """Maximal runs of bytes with ``inside`` set, never across rows."""
    n = len(inside)
    before = np.empty(n, bool)
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[:-1] = inside[1:]
    bounds = texts.offsets
    before[bounds[:-1][bounds[:-1] < n]] = False
    after[(bounds[1:] - 1)[bounds[1:] > 0]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, bounds))


def find_words(texts: Texts) -> Words:
    return find_runs(texts, ~SPACE[texts.data])


def find_lines(texts: Texts) -> Words:
    """Pieces between newlines, empty ones too; a row has one more than it has newlines."""
    breaks = np.flatnonzero(texts.data == 0x0A)
    per_row = np.diff(np.searchsorted(breaks, texts.offsets)) + 1
    rows = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(per_row, out=rows[1:])
    starts, ends = np.empty(rows[-1], np.int64), np.empty(rows[-1], np.int64)
    first, last = np.zeros(rows[-1], bool), np.zeros(rows[-1], bool)
    first[rows[:-1]] = last[rows[1:] - 1] = True
    starts[first], ends[last] = texts.offsets[:-1], texts.offsets[1:]
    starts[~first], ends[~last] = breaks + 1, breaks
    return Words(starts, ends, rows)


def slices(column: pa.Array | pa.ChunkedArray, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, end row, texts) of runs of rows of at most ``max_bytes``, or of one long row."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    chars = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(at, at[low] + max_bytes, "right")) - 1)
        yield low, high, Texts(chars[at[low]:at[high]], at[low:high + 1] - at[low])
        low = high


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes; of the whole sequence where it is shorter."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    value = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        value = value * np.uint64(0x2545F4914F6CDD1D) + words[k:len(words) - size + 1 + k]
    return mix(value + np.uint64(size))
