"""Benchmark decontamination: a prefix-filtered containment join of item windows with documents.

A window is contained in a text only if all its shingles are, so the necessary prefix of its shingles,
ordered by rarity, is the rarest one. Documents are probed with those alone; a hit fixes where the
window would have to lie, bounds drop the ones that do not fit, and the words are compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenrec.llm.columns import apart, text_place
from goldenrec.llm.words import (
    ALNUM,
    LOWER,
    SMALL_SLICE_BYTES,
    Slice,
    Words,
    find_words,
    list_array,
    row_starts,
    sequence_hash,
    signed,
    slices,
    windows,
)
from goldenrec.session import stage

WINDOW_WORDS = 10
SHINGLE_WORDS = 5
# Item windows sent to the tasks at once (about 20 MB); more of them are more passes over the documents.
BLOCK_WINDOWS = 100_000

_U = np.uint64
WINDOWS = "item string, words int, hash long, text string, shingles array<long>"
HITS = "n_words long, hits array<struct<item:string,first:int,last:int>>"


def _own_words(part: Slice, words: Words, first: np.ndarray, size: np.ndarray) -> list[str]:
    """Texts of word runs, lower-cased, joined by one space."""
    data = LOWER[part.data].tobytes()
    found = []
    for begin, count in zip(first.tolist(), size.tolist(), strict=True):
        run = range(begin, begin + count)
        found.append(b" ".join(data[words.start[i] : words.end[i]] for i in run).decode())
    return found


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of the items: 10 consecutive words, or all words of a shorter item."""
    for batch in batches:
        for part in slices(batch.column(1)):
            words = find_words(part, ALNUM, LOWER)
            starts = row_starts(words)
            first, _ = windows(words, WINDOW_WORDS)
            short = np.flatnonzero((words.count > 0) & (words.count < WINDOW_WORDS))
            first = np.concatenate([first, starts[short]])
            size = np.minimum(words.count[words.row[first]], WINDOW_WORDS)
            hashes, shingles = [], []
            for begin, count in zip(first.tolist(), size.tolist(), strict=True):
                own = words.hash[begin : begin + count]
                hashes.append(int(signed(sequence_hash(own, count))[0]))
                shingles.append(signed(sequence_hash(own, min(SHINGLE_WORDS, count))))
            ids = batch.column(0).slice(part.first, part.rows).take(pa.array(words.row[first]))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(size.astype(np.int32)),
                    pa.array(hashes, pa.int64()),
                    pa.array(_own_words(part, words, first, size), pa.string()),
                    list_array(
                        np.array([len(x) for x in shingles], np.int64),
                        pa.array(np.concatenate([np.zeros(0, np.int64), *shingles])),
                    ),
                ],
                ["item", "words", "hash", "text", "shingles"],
            )


class Block(NamedTuple):
    """Windows sorted by their rarest shingle, the first one of each bucket at ``begins``."""

    shingle: np.ndarray
    offset: np.ndarray
    words: np.ndarray
    hash: np.ndarray
    item: np.ndarray
    text: list[str]
    items: list[str]
    sizes: list[int]


def _in_sorted(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def _count_shingles(vocabulary) -> Callable:
    """Task function: how often each known shingle occurs, summed per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sizes = vocabulary.value
        for batch in batches:
            for part in slices(batch.column(0), SMALL_SLICE_BYTES):
                words = find_words(part, ALNUM, LOWER)
                for size in sizes:
                    _, hashes = windows(words, size)
                    own = hashes[_in_sorted(hashes, known)]
                    values, counts = np.unique(own, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(values)), pa.array(counts.astype(np.int64))], ["shingle", "n"]
                    )

    return run


def _hits(part: Slice, words: Words, block: Block) -> tuple[np.ndarray, ...]:
    """(row, item, first word, last word + 1) of all windows that occur, in order, merged where they touch."""
    starts = row_starts(words)
    row, item, first, last = [], [], [], []
    data = None
    for size in block.sizes:
        at, hashes = windows(words, size)
        probe = _in_sorted(hashes, block.shingle)
        at, hashes = at[probe], hashes[probe]
        low = np.searchsorted(block.shingle, hashes, "left")
        count = np.searchsorted(block.shingle, hashes, "right") - low
        at = np.repeat(at, count)
        window = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else low, count)
        window = window + np.arange(len(window))
        # where the window would begin; it must lie within the document
        own = words.row[at]
        begin = at - block.offset[window]
        length = block.words[window]
        fits = (begin >= starts[own]) & (begin + length <= starts[own + 1])
        window, begin, length, own = window[fits], begin[fits], length[fits], own[fits]
        for count_ in np.unique(length):
            here = np.flatnonzero(length == count_)
            full = sequence_hash(words.hash, int(count_))
            here = here[full[begin[here]] == block.hash[window[here]]]
            if not len(here):
                continue
            data = LOWER[part.data].tobytes() if data is None else data
            for place in here.tolist():
                run = range(begin[place], begin[place] + count_)
                text = b" ".join(data[words.start[i] : words.end[i]] for i in run).decode()
                if text == block.text[window[place]]:
                    row.append(own[place])
                    item.append(block.item[window[place]])
                    first.append(begin[place] - starts[own[place]])
                    last.append(begin[place] - starts[own[place]] + count_)
    row, item, first, last = (np.array(x, np.int64) for x in (row, item, first, last))
    order = np.lexsort((first, item, row))
    row, item, first, last = row[order], item[order], first[order], last[order]
    other = np.ones(len(row), bool)
    other[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    # windows of one item may differ in length, so the farthest end so far counts, not that of the last window
    group = np.cumsum(other) * (last.max() + 1 if len(last) else 1)
    upto = np.maximum.accumulate(last + group) - group
    fresh = other.copy()
    fresh[1:] |= first[1:] > upto[:-1]
    begins = np.flatnonzero(fresh)
    ends = np.concatenate([begins[1:], [len(row)]]) - 1 if len(begins) else begins
    return row[begins], item[begins], first[begins], upto[ends]


def _find(shared, names: list[str]) -> Callable:
    """Task function: documents with the windows of the block that occur in them; columns pass through."""
    text = text_place(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        items = pa.array(block.items, pa.string())
        for batch in batches:
            for part in slices(batch.column(text), SMALL_SLICE_BYTES):
                words = find_words(part, ALNUM, LOWER)
                row, item, first, last = _hits(part, words, block)
                entries = pa.StructArray.from_arrays(
                    [items.take(pa.array(item)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                    ["item", "first", "last"],
                )
                own = batch.slice(part.first, part.rows)
                found = [pa.array(words.count.astype(np.int64)), list_array(np.bincount(row, minlength=part.rows), entries)]
                yield pa.RecordBatch.from_arrays([*own.columns, *found], [*names, "n_words", "hits"])

    return run


def _block(spark: SparkSession, windows_: DataFrame, texts: DataFrame):
    """The windows of one block with the rarest shingle of each, as a broadcast value."""
    rows = windows_.collect()
    known = np.unique(np.array([s for row in rows for s in row.shingles], np.int64).view(_U))
    sizes = sorted({min(SHINGLE_WORDS, row.words) for row in rows})
    vocabulary = spark.sparkContext.broadcast((known, sizes))
    counted = texts.mapInArrow(_count_shingles(vocabulary), "shingle long, n long")
    # at most one row per shingle of the block
    often = {row.shingle: row.n for row in counted.groupBy("shingle").agg(F.sum("n").alias("n")).collect()}
    vocabulary.destroy()
    offset = [min(range(len(r.shingles)), key=lambda i: (often.get(r.shingles[i], 0), r.shingles[i])) for r in rows]
    rarest = np.array([row.shingles[i] for row, i in zip(rows, offset, strict=True)], np.int64).view(_U)
    order = np.argsort(rarest, kind="stable")
    items = sorted({row.item for row in rows})
    number = {item: place for place, item in enumerate(items)}
    return spark.sparkContext.broadcast(
        Block(
            rarest[order],
            np.array(offset, np.int64)[order],
            np.array([row.words for row in rows], np.int64)[order],
            np.array([row.hash for row in rows], np.int64).view(_U)[order],
            np.array([number[row.item] for row in rows], np.int64)[order],
            [rows[i].text for i in order],
            items,
            sizes,
        )
    )


def _covered(hits: Column) -> Column:
    """Number of words under any hit."""
    spans = F.array_sort(F.transform(hits, lambda hit: F.struct(hit["first"], hit["last"])))
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("total"))

    def add(state: Column, span: Column) -> Column:
        new = F.greatest(span["last"] - F.greatest(state["upto"], span["first"]), F.lit(0))
        return F.struct(
            F.greatest(state["upto"], span["last"]).alias("upto"), (state["total"] + new).alias("total")
        )

    return F.aggregate(spans, start, add, lambda state: state["total"])


def find_contamination(docs: DataFrame, items: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with ``n_words, n_hit, items, hits``; ``items(item_id, text)`` are the benchmark.

    Words are lower-cased runs of letters, digits and non-ASCII characters. ``hits`` are word ranges
    ``(item, first, last)`` under windows that occur, ``items`` the ids found, sorted as text, and ``n_hit`` the
    words under any range.

    NULL text: no words, no hits. An item without words has no window. NULL item_id: reported as ''.
    Repeated items count once, repeated documents each. NULL doc_id: an id like any other. An empty
    benchmark hits nothing. Other columns pass through; input columns with a result's name are replaced.

    Windows reach the tasks in blocks of about ``block_windows``; each block is a pass over the documents to
    count its shingles and one to find them. Only further blocks need a join of what they found.
    """
    spark = docs.sparkSession
    docs, restored = apart(docs.drop("n_words", "n_hit", "items", "hits"), ("_version", "_id", "_v", "_hits"))
    kept = docs.withColumn("_version", F.xxhash64("text"))
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    found = stage(named.mapInArrow(_item_windows, WINDOWS).dropDuplicates(["item", "text"]), "item-windows")
    blocks = max(-(-found.count() // block_windows), 1)

    def search(number: int, source: DataFrame) -> DataFrame:
        own = found.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number)
        shared = _block(spark, own, docs.select("text"))
        schema = T.StructType([*source.schema.fields, *T.DataType.fromDDL(HITS).fields])
        return source.mapInArrow(_find(shared, source.columns), schema)

    result = search(0, kept)
    for number in range(1, blocks):
        part = search(number, docs.select("doc_id", F.xxhash64("text").alias("_v"), "text")).drop("text", "n_words")
        more = part.where(F.size("hits") > 0).dropDuplicates(["doc_id", "_v"])
        more = more.withColumnsRenamed({"doc_id": "_id", "hits": "_hits"})
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_version") == F.col("_v"))
        joined = result.join(more, same, "left")
        both = F.when(F.col("_hits").isNull(), F.col("hits")).otherwise(F.concat("hits", "_hits"))
        result = joined.withColumn("hits", both).drop("_id", "_v", "_hits")
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda hit: hit["item"])))
    return restored(result.drop("_version").withColumns({"n_hit": _covered(F.col("hits")), "items": names}))
