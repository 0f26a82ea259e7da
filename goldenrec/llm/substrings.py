"""Exact repeats of 13 and more words: fixed-block anchors, rolling probes, extension.

The index holds the non-overlapping 7-word blocks of every document; every rolling 7-word window of
every document probes it. Any 13 consecutive words contain a whole block of their own document, so a
repeat that is not hit by a probe cannot have 13 words. Hits are extended: of the windows around
them, those found at an earlier document are the maximal exact repeats.

Blocks and probes travel packed, about 5 bytes each: rows of (part, bytes), one per part and slice of
text, where the part is a function of the block's hash. One part is worked on as arrays in one task, so
``parts`` (the session's shuffle partitions) is to be set like that of any shuffle. Equal blocks
of a hundred documents are a hundred entries; nothing is paired.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenrec.llm.words import (
    SPACED,
    Words,
    find_words,
    list_array,
    mix64,
    row_starts,
    sequence_hash,
    slices,
    windows,
)

WINDOW_WORDS = 13
# Largest size of which any window holds a whole aligned block: 2 * 7 - 1 = 13.
BLOCK_WORDS = 7

_U = np.uint64
PACKED = "part int, entries binary"
PLACES = "d long, version long, places array<int>"
# Bytes of the two hashes that travel with an entry, beside its part, which is as good as more bits of the
# first. An anchor may be wrong: it only marks windows to look at, and as parts grow with the data the share
# of wrong ones does not. A window decides, so it has 72 bits and the part.
ANCHOR_BYTES = (4, 0)
WINDOW_BYTES = (7, 2)


def _planes(values: np.ndarray) -> bytes:
    """Little-endian integers, all first bytes before all second ones: small values compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplane(data: memoryview, count: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, count).T).view(kind).reshape(-1)


def _narrow(values: np.ndarray, width: int) -> bytes:
    return values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(data: memoryview, count: int, width: int) -> np.ndarray:
    whole = np.zeros((count, 8), np.uint8)
    whole[:, :width] = np.frombuffer(data, np.uint8).reshape(count, width)
    return whole.view(_U).reshape(-1)


class Entries(NamedTuple):
    """Places in documents; ``flag`` and the two hashes are empty where nobody asks for them."""

    d: np.ndarray
    version: np.ndarray
    place: np.ndarray
    flag: np.ndarray
    first: np.ndarray
    second: np.ndarray

    def at(self, chosen: np.ndarray) -> Entries:
        return Entries(*(column[chosen] if len(column) else column for column in self))


_NO_FLAG, _NO_HASH = np.zeros(0, bool), np.zeros(0, _U)


def _pack(entries: Entries, part: np.ndarray, parts: int, widths: tuple[int, int]) -> pa.RecordBatch:
    """One row per part. Entries of a document follow each other in the order of their places."""
    order = np.argsort(part, kind="stable")
    entries = entries.at(order)
    borders = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])
    numbers, packed = [], []
    for number in np.flatnonzero(np.diff(borders)):
        d, version, place, flag, first, second = entries.at(slice(borders[number], borders[number + 1]))
        fresh = np.ones(len(d), bool)
        fresh[1:] = (d[1:] != d[:-1]) | (version[1:] != version[:-1]) | (place[1:] < place[:-1])
        begins = np.flatnonzero(fresh)
        gap = place.astype(np.uint32)
        gap[1:][~fresh[1:]] -= place[:-1][~fresh[1:]].astype(np.uint32)
        pieces = [
            np.array([len(d), len(begins)], np.uint32).tobytes(),
            _planes(d[begins]),
            _planes(version[begins]),
            _planes(np.diff(np.concatenate([begins, [len(d)]])).astype(np.uint32)),
            _planes(gap),
        ]
        if len(flag):
            pieces.append(np.packbits(flag).tobytes())
        pieces += [_narrow(values, width) for values, width in ((first, widths[0]), (second, widths[1])) if width]
        numbers.append(number)
        packed.append(b"".join(pieces))
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array(packed, pa.binary())], ["part", "entries"]
    )


def _unpack(data: bytes, widths: tuple[int, int], flagged: bool) -> Entries:
    view, at = memoryview(data), 8
    count, documents = np.frombuffer(view[:8], np.uint32).astype(int)

    def take(size: int) -> memoryview:
        nonlocal at
        at += size
        return view[at - size : at]

    d = _unplane(take(8 * documents), documents, np.int64)
    version = _unplane(take(8 * documents), documents, np.int64)
    runs = _unplane(take(4 * documents), documents, np.uint32)
    gap = _unplane(take(4 * count), count, np.uint32).astype(np.int64)
    flag = np.unpackbits(np.frombuffer(take((count + 7) // 8), np.uint8), count=count).astype(bool) if flagged else _NO_FLAG
    first, second = (_wide(take(width * count), count, width) if width else _NO_HASH for width in widths)
    sums = np.cumsum(gap)
    begins = np.cumsum(runs.astype(np.int64)) - runs
    place = sums - np.repeat(sums[begins] - gap[begins], runs)
    return Entries(np.repeat(d, runs), np.repeat(version, runs), place.astype(np.int32), flag, first, second)


def _partition(batches: Iterator[pa.RecordBatch], widths: tuple[int, int], flagged: bool) -> Iterator[Entries]:
    """All entries of each part of a partition."""
    gathered: dict[int, list[Entries]] = {}
    for batch in batches:
        for number, entries in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            gathered.setdefault(number, []).append(_unpack(entries.as_py(), widths, flagged))
    while gathered:
        _, own = gathered.popitem()
        yield Entries(*(np.concatenate(column) for column in zip(*own, strict=True)))


def _resolve(parts: int, widths: tuple[int, int], flagged: bool, choose: Callable) -> Callable:
    """Task function: entries of a part grouped by hash; those that ``choose`` marks go to their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for entries in _partition(batches, widths, flagged):
            keys = [entries.first, entries.second] if widths[1] else [entries.first]
            order = np.lexsort(keys)
            keys = [key[order] for key in keys]
            fresh = np.ones(len(order), bool)
            fresh[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
            flag = entries.flag[order] if flagged else _NO_FLAG
            chosen = order[choose(entries.d[order], flag, np.flatnonzero(fresh), np.cumsum(fresh) - 1)]
            found = Entries(entries.d[chosen], entries.version[chosen], entries.place[chosen], _NO_FLAG, _NO_HASH, _NO_HASH)
            found = found.at(np.lexsort((found.place, found.version, found.d)))
            part = (mix64(found.d.view(_U)) % _U(parts)).astype(np.int32)
            yield _pack(found, part, parts, (0, 0))

    return run


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with all its places."""
    for entries in _partition(batches, (0, 0), False):
        d, version, place = entries.at(np.lexsort((entries.place, entries.version, entries.d)))[:3]
        fresh = np.ones(len(d), bool)
        fresh[1:] = (d[1:] != d[:-1]) | (version[1:] != version[:-1])
        begins = np.flatnonzero(fresh)
        lengths = np.diff(np.concatenate([begins, [len(d)]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(d[begins]), pa.array(version[begins]), list_array(lengths, pa.array(place))],
            ["d", "version", "places"],
        )


def _shared_anchor(d, flag, begins, group):
    """Entries whose block is in the index and occurs in two documents."""
    indexed = np.logical_or.reduceat(flag, begins)
    several = np.minimum.reduceat(d, begins) != np.maximum.reduceat(d, begins)
    return (indexed & several)[group]


def _not_first(d, flag, begins, group):
    """Entries of windows that also start in a document with a smaller id."""
    return d > np.minimum.reduceat(d, begins)[group]


def _place(words: Words, first: np.ndarray) -> np.ndarray:
    return first - row_starts(words)[words.row[first]]


def _blocks(parts: int) -> Callable:
    """Task function: index blocks (flag set) and probes of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            for part in slices(batch.column(3)):
                words = find_words(part, SPACED)
                first, hashes = windows(words, BLOCK_WORDS)
                place = _place(words, first)
                row = words.row[first] + part.first
                entries = Entries(
                    ids[row], versions[row], place, place % BLOCK_WORDS == 0, hashes // _U(parts), _NO_HASH
                )
                yield _pack(entries, (hashes % _U(parts)).astype(np.int32), parts, ANCHOR_BYTES)

    return run


def _spread(part_rows: int, row: np.ndarray, place: np.ndarray, before: int, after: int, starts: np.ndarray):
    """Flag of every word that is at most ``before`` ahead of or ``after`` behind one of the places."""
    change = np.zeros(starts[-1] + 1, np.int32)
    at = starts[row] + place
    np.add.at(change, np.maximum(at - before, starts[row]), 1)
    np.add.at(change, np.minimum(at + after + 1, starts[row + 1]), -1)
    return np.cumsum(change[:-1]) > 0


def _places_of(column: pa.Array, first: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the list entries of some rows."""
    lists = column.slice(first, rows)
    lengths = np.zeros(rows, np.int64)
    known = np.flatnonzero(np.asarray(lists.is_valid()))
    values = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(np.asarray(lists.offsets))
    lengths[known] = sizes[known]
    return np.repeat(np.arange(rows), lengths), values


def _candidates(parts: int) -> Callable:
    """Task function: all windows that hold a shared anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            for part in slices(batch.column(3)):
                words = find_words(part, SPACED)
                row, place = _places_of(batch.column(4), part.first, part.rows)
                starts = row_starts(words)
                # a place beyond the text belongs to another row with this doc_id
                fits = place < words.count[row]
                marked = _spread(part.rows, row[fits], place[fits], WINDOW_WORDS - BLOCK_WORDS, 0, starts)
                first, hashes = windows(words, WINDOW_WORDS)
                again = sequence_hash(mix64(words.hash ^ _U(0x5EED5EED)), WINDOW_WORDS)[first]
                wanted = marked[first]
                first, hashes, again = first[wanted], hashes[wanted], again[wanted]
                row = words.row[first] + part.first
                entries = Entries(ids[row], versions[row], _place(words, first), _NO_FLAG, hashes // _U(parts), again)
                yield _pack(entries, (hashes % _U(parts)).astype(np.int32), parts, WINDOW_BYTES)

    return run


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words left over, joined by one space."""
    for batch in batches:
        for part in slices(batch.column(3)):
            words = find_words(part, SPACED)
            starts = row_starts(words)
            row, place = _places_of(batch.column(4), part.first, part.rows)
            removed = _spread(part.rows, row, place, 0, WINDOW_WORDS - 1, starts)
            keep = np.flatnonzero(~removed)
            own = words.row[keep]
            change = np.zeros(len(part.data) + 1, np.int8)
            change[words.start[keep]] += 1
            change[words.end[keep]] -= 1
            inside = np.cumsum(change[:-1], dtype=np.int8) > 0
            # the byte behind every kept word but a row's last is white space and becomes its separator
            inner = keep[:-1][own[:-1] == own[1:]] if len(keep) else keep
            behind = words.end[inner]
            data = part.data.copy()
            data[behind] = 0x20
            inside[behind] = True
            places = np.concatenate([[0], np.cumsum(inside)])[part.offsets]
            text = pa.LargeStringArray.from_buffers(
                part.rows, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data[inside])
            )
            removed_per_row = np.bincount(words.row[removed], minlength=part.rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).slice(part.first, part.rows),
                    pa.array(words.count.astype(np.int64)),
                    pa.array(removed_per_row.astype(np.int64)),
                    text.cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )


def _gathered(packed: DataFrame, parts: int, widths: tuple[int, int], flagged: bool, choose: Callable) -> DataFrame:
    """(d, version, places) of the chosen entries, one row per document."""
    chosen = packed.repartitionById(parts, "part").mapInArrow(_resolve(parts, widths, flagged, choose), PACKED)
    return chosen.repartitionById(parts, "part").mapInArrow(_by_document, PLACES)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row of ``docs(doc_id, text)``.

    Removed is each word (a run of bytes other than space and 0x09-0x0D) that a window of 13 words
    covers whose words also start somewhere in a document with a smaller doc_id, judged on the input.
    The words left are joined by one space.

    NULL text: no words, empty rest. NULL doc_id: comes after all ids, in the order of a hash of the
    text; equal texts without id keep both. Rows repeating a doc_id are one document to each other
    (neither is smaller), each judged by its own text. Other columns are ignored.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text_hash = F.xxhash64("text")
    without_id = F.lit(2**62) + F.shiftrightunsigned(text_hash, 2)
    # the same exchange of this table feeds both joins: texts are shuffled once
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), without_id).alias("d"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_hash.alias("version"),
        "text",
    )
    # the version of an anchor is not asked: its places may belong to any text with this id
    anchors = _gathered(keyed.mapInArrow(_blocks(parts), PACKED), parts, ANCHOR_BYTES, True, _shared_anchor)
    around = keyed.join(anchors.select("d", "places"), "d").select("d", "doc_id", "version", "text", "places")
    repeats = _gathered(around.mapInArrow(_candidates(parts), PACKED), parts, WINDOW_BYTES, False, _not_first)
    repeats = repeats.select("d", F.col("version").alias("_version"), "places")
    # not an equality of two columns: the join is by d alone, as the first one
    same_text = F.col("version").bitwiseXOR(F.col("_version")) == 0
    left = keyed.join(repeats.withColumnRenamed("d", "_d"), (F.col("d") == F.col("_d")) & same_text, "left")
    rest = left.select("d", "doc_id", "version", "text", "places")
    return rest.mapInArrow(_strip, "doc_id long, n_words long, n_removed long, kept_text string")
