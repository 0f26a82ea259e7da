"""Words, windows and their hashes of whole Arrow text columns, by array arithmetic over the bytes.

No Python string is made per word: a batch is cut into slices of a few MB, the word borders come from
a table look-up per byte, and every word gets a 64-bit hash from prefix sums of a polynomial. UTF-8
keeps all separators used here in the ASCII range, so bytes decide exactly as characters would.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at once; a longer document is a slice of its own.
SLICE_BYTES = 1 << 21
# The same for operators that follow one another in one session: a worker keeps some 60 bytes for each byte of its
# largest slice, beside an executor that has filled its heap.
SMALL_SLICE_BYTES = 1 << 19

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_STEP = _U(0xD1342543DE82EF95)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# The two definitions of a word.
SPACED = np.ones(256, bool)
SPACED[0x20] = False
SPACED[0x09:0x0E] = False
ALNUM = np.ones(256, bool)
ALNUM[0x00:0x30] = ALNUM[0x3A:0x61] = ALNUM[0x7B:0x80] = False

_powers = np.ones(1, _U)
_inverse = np.ones(1, _U)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finaliser of a public hash)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _grow(size: int) -> None:
    """Powers of the base and of its inverse modulo 2**64, kept between calls."""
    global _powers, _inverse
    if len(_powers) < size:
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        _powers = np.concatenate([np.ones(1, _U), np.cumprod(np.full(size - 1, _BASE, _U), dtype=_U)])
        _inverse = np.concatenate([np.ones(1, _U), np.cumprod(np.full(size - 1, inverse, _U), dtype=_U)])


class Slice(NamedTuple):
    """Rows ``first .. first + len(offsets) - 1`` of a batch and their bytes."""

    first: int
    offsets: np.ndarray
    data: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """One entry per word: row within the slice, byte range, hash; ``count`` has words per row."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    count: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Consecutive row ranges of a text column; NULL counts as empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return
    _, places, values = column.buffers()
    places = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(places, places[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Slice(first, places[first : last + 1] - places[first], data[places[first] : places[last]])
        first = last


def find_words(
    part: Slice, kind: np.ndarray, fold: np.ndarray | None = None, after: np.ndarray | None = None
) -> Words:
    """Words of a slice: maximal runs of bytes that ``kind`` allows, after ``fold`` is applied.

    ``after`` marks bytes that end a word even inside such a run.
    """
    data = part.data if fold is None else fold[part.data]
    size = len(data)
    inside = np.zeros(size + 2, bool)
    inside[1:-1] = kind[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    borders = part.offsets[1:-1]
    borders = borders[(borders > 0) & (borders < size)]
    begins[borders] = inside[1:-1][borders]
    ends[borders - 1] = inside[1:-1][borders - 1]
    if after is not None:
        ends |= inside[1:-1] & after
        begins[1:] |= inside[2:-1] & after[:-1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    _grow(size + 1)
    sums = np.zeros(size + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * _powers[:size], out=sums[1:])
    hashes = mix64((sums[end] - sums[start]) * _inverse[start])
    row = np.searchsorted(part.offsets, start, "right") - 1
    return Words(row, start, end, hashes, np.bincount(row, minlength=part.rows))


def sequence_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive entries."""
    count = max(len(hashes) - size + 1, 0)
    total = np.zeros(count, _U)
    for place in range(size):
        total = total * _STEP + hashes[place : place + count]
    return mix64(total)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every window of ``size`` words that lies within one row."""
    hashes = sequence_hash(words.hash, size)
    first = np.flatnonzero(words.row[: len(hashes)] == words.row[size - 1 : size - 1 + len(hashes)])
    return first, hashes[first]


def row_starts(words: Words) -> np.ndarray:
    """Index of the first word of every row (and the end of the last)."""
    return np.concatenate([[0], np.cumsum(words.count)])


def cut(batch: pa.RecordBatch, columns: list[int], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text in the given columns."""
    size = np.zeros(batch.num_rows + 1, np.int64)
    for column in columns:
        size[1:] += pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    size = np.cumsum(size)
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(size, size[first] + limit, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def list_array(lengths: np.ndarray, values: pa.Array) -> pa.Array:
    """List column from the length of each list and all values in order."""
    places = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(places), values)
