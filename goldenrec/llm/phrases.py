"""Phrase collocations from word suffix trees that are cut at a depth and built group by group.

The prefixes of all word suffixes are dealt to groups that fit a memory budget. A group over the budget is divided
by longer prefixes until all fit. Each group then sorts its suffixes, cut to the longest phrase, into the
leaf order of their tree: a node is a run of leaves, and its phrase occurs as often as the totals of these leaves say.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenrec.llm.words import LOWER, Slice, find_words, mix64, slices
from goldenrec.session import stage

# Words of the longest phrase: the depth at which the trees are cut.
DEPTH = 3
# Phrases of fewer occurrences are none.
LEAST = 10
# First phrases of each language.
REPORTED = 2000
# Language of texts without one.
UNKNOWN = "und"
# Bytes of text whose suffixes are listed at once, and leaves that are counted together before they are dealt.
SLICE = 1 << 22
HELD = 1 << 20
# Leaves that a group may hold: some 100 bytes each while they are sorted.
BUDGET = 1 << 21
# Prefixes are counted in this many buckets: a table of half a MB at any size of the corpus.
BUCKET_BITS = 16
# Parts of a group that turns out too large while it is built.
PIECES = 16

# Pieces end at these signs, words at these and at blanks.
BREAK = np.zeros(256, bool)
BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
WORD = ~BREAK
WORD[list(b" \t")] = False

GROUPED = "part long, level int, size long, leaves binary"
NODES = "lang string, first string, second string, third string, depth int, f long"
KEYS = ("lang", "first", "second", "third", "depth")
BUILT_NAMES = [*KEYS, "f", "part", "level", "size", "leaves"]

_U = np.uint64


class Leaves:
    """Suffixes with totals: language and first word, second and third word (0: none, else number + 1)."""

    def __init__(self, words: pa.Array, langs: pa.Array, columns: list[np.ndarray]) -> None:
        self.words = words
        self.langs = langs
        # lang, first, second, third, total
        self.columns = columns

    def __len__(self) -> int:
        return len(self.columns[0])

    def hashes(self, depth: int) -> np.ndarray:
        """Hash of each suffix's prefix of ``depth`` words and of its language; it only deals suffixes out."""
        words = np.concatenate([np.zeros(1, _U), _text_hashes(self.words)])
        total = _text_hashes(self.langs)[self.columns[0]]
        for place in range(1, depth + 1):
            total = mix64(total * _U(31) + words[self.columns[place] + (place == 1)])
        return total

    def packed(self, rows: np.ndarray) -> bytes:
        """These rows, in order, with only the words they hold."""
        lang, first, second, third, total = (column[rows] for column in self.columns)
        used = np.unique(np.concatenate([first + 1, second, third]))
        used = used[used > 0]
        langs = np.unique(lang)

        def number(values: np.ndarray) -> np.ndarray:
            return np.where(values > 0, np.searchsorted(used, values) + 1, 0)

        # rows come sorted by language and first word: differences are mostly 0
        first = np.diff(number(first + 1) - 1, prepend=0)
        numbers = [np.searchsorted(langs, lang), first, number(second), number(third), total]
        texts = [self.words.take(pa.array(used - 1)), self.langs.take(pa.array(langs))]
        parts = []
        for text in texts:
            offsets, data = _bytes(text)
            parts += [np.diff(offsets), data]
        return _pack([*numbers, *parts])

    @staticmethod
    def unpacked(data: bytes) -> Leaves:
        *numbers, word_sizes, words, lang_sizes, langs = _unpack(data)
        numbers[1] = np.cumsum(numbers[1])
        numbers = [*(column.astype(np.int32) for column in numbers[:4]), numbers[4].astype(np.int64)]
        return Leaves(_texts(word_sizes, words), _texts(lang_sizes, langs), numbers)

    @staticmethod
    def joined(parts: list[Leaves]) -> Leaves:
        """All parts with one numbering of words and languages."""
        words = pa.chunked_array([part.words for part in parts], pa.large_utf8()).combine_chunks().dictionary_encode()
        langs = pa.chunked_array([part.langs for part in parts], pa.large_utf8()).combine_chunks().dictionary_encode()
        word_of, lang_of = (np.asarray(x.indices) for x in (words, langs))
        shifted: list[list[np.ndarray]] = [[], [], [], [], []]
        words_before = langs_before = 0
        for part in parts:
            own = np.zeros(len(part.words) + 1, np.int32)
            own[1:] = word_of[words_before : words_before + len(part.words)] + 1
            lang, first, second, third, total = part.columns
            shifted[0].append(lang_of[langs_before + lang])
            shifted[1].append(own[first + 1] - 1)
            shifted[2].append(own[second])
            shifted[3].append(own[third])
            shifted[4].append(total)
            words_before += len(part.words)
            langs_before += len(part.langs)
        return Leaves(words.dictionary, langs.dictionary, [np.concatenate(column) for column in shifted])

    def merged(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Sorted distinct suffixes, and where in them the nodes of depth 0 (the language) to 3 begin."""
        lang, first, second, third, total = self.columns
        size = len(self.words) + 1
        branch = (lang.astype(np.int64) * size + first) * size + second
        order = np.lexsort((third, branch))
        branch, third, total = branch[order], third[order], total[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (branch[1:] != branch[:-1]) | (third[1:] != third[:-1])
        starts = np.flatnonzero(fresh)
        total = np.add.reduceat(total, starts) if len(starts) else total
        branch, third, order = branch[starts], third[starts], order[starts]
        begins = []
        for key in (branch // size**2, branch // size, branch):
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            begins.append(np.flatnonzero(new))
        begins.append(np.arange(len(starts)))
        return [lang[order], first[order], second[order], third, total], begins


def _bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and the bytes of a large text array."""
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def _texts(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
    return pa.Array.from_buffers(pa.large_utf8(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _text_hashes(text: pa.Array) -> np.ndarray:
    found = np.zeros(len(text), _U)
    # an empty language has no word to hash
    words = find_words(Slice(0, *_bytes(text)), np.ones(256, bool))
    found[words.row] = words.hash
    return found


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Numbers by byte planes, compressed: high bytes are mostly equal."""
    head, planes = [len(arrays)], []
    for array in arrays:
        wide = array.dtype != np.uint8
        least = int(array.min()) if wide and len(array) else 0
        array = (array - least).astype("<u8") if wide else array
        width = max(1, (int(array.max()).bit_length() + 7) // 8) if len(array) else 1
        head += [len(array), width, least]
        planes.append(array.view(np.uint8).reshape(len(array), array.itemsize)[:, :width].T.tobytes())
    raw = np.array(head, "<i8").tobytes() + b"".join(planes)
    return np.int64(len(raw)).tobytes() + pa.Codec("zstd").compress(raw, asbytes=True)


def _unpack(data: bytes) -> list[np.ndarray]:
    size = int(np.frombuffer(data, "<i8", 1)[0])
    raw = pa.Codec("zstd").decompress(data[8:], size, asbytes=True)
    count = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 3 * count, 8).reshape(count, 3)
    found, at = [], 8 + 24 * count
    for length, width, least in head.tolist():
        planes = np.frombuffer(raw, np.uint8, length * width, at).reshape(width, length)
        at += length * width
        if width == 1 and not least:
            found.append(planes[0])
            continue
        array = np.zeros(length, np.int64)
        for place in range(width):
            array |= planes[place].astype(np.int64) << (8 * place)
        found.append(array + least)
    return found


def _words(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte and length of every word: no word crosses the end of a row."""
    inside = WORD[part.data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    borders = part.offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(inside))]
    begins[borders] = inside[borders]
    ends[borders - 1] = inside[borders - 1]
    start = np.flatnonzero(begins)
    row = np.searchsorted(part.offsets, start, "right") - 1
    return row, start, np.flatnonzero(ends) + 1 - start


def _coded(part: Slice, langs: pa.Array) -> tuple[pa.Array, pa.Array, list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct words and languages of a slice; (language, word) of all its words, and their rows and first bytes."""
    row, start, size = _words(part)
    # the words one behind the other are the bytes that belong to words
    words = _texts(size, LOWER[part.data[WORD[part.data]]]).dictionary_encode()
    langs = langs.dictionary_encode()
    lang = np.asarray(langs.indices)[row]
    return words.dictionary, langs.dictionary, [lang, np.asarray(words.indices)], row, start


def suffixes(part: Slice, langs: pa.Array) -> Leaves:
    """Every word of a slice with the two that follow it in its piece, counted."""
    words, names, (lang, code), row, start = _coded(part, langs)
    code = code.astype(np.int64)
    piece = np.searchsorted(np.flatnonzero(BREAK[part.data]), start)
    along = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
    second = np.zeros(len(code), np.int64)
    second[:-1][along] = code[1:][along] + 1
    third = np.zeros(len(code), np.int64)
    third[:-2][along[:-1] & along[1:]] = code[2:][along[:-1] & along[1:]] + 1
    size = len(words) + 1
    branch, branch_of = np.unique((lang * size + code) * size + second, return_inverse=True)
    leaf, total = np.unique(branch_of * size + third, return_counts=True)
    branch = branch[leaf // size]
    stem = branch // size
    columns = [column.astype(np.int32) for column in (stem // size, stem % size, branch % size, leaf % size)]
    return Leaves(words, names, [*columns, total.astype(np.int64)])


class Deal(NamedTuple):
    """Group of each prefix bucket: ``base + hash of one more word % pieces``."""

    base: np.ndarray
    pieces: np.ndarray

    @staticmethod
    def packed(sizes: np.ndarray, budget: int) -> Deal:
        """Consecutive buckets share a group while they fit; one over the budget is divided by longer prefixes."""
        pieces = np.maximum(-(-2 * sizes // budget), 1)
        pieces[sizes <= budget] = 1
        base = np.zeros(len(sizes), np.int64)
        group = held = 0
        for bucket in np.flatnonzero(sizes).tolist():
            if held + sizes[bucket] > budget and held:
                group, held = group + 1, 0
            base[bucket] = group
            held += sizes[bucket]
            if pieces[bucket] > 1:
                group, held = group + int(pieces[bucket]), 0
        return Deal(base, pieces)

    def groups(self, leaves: Leaves) -> tuple[np.ndarray, np.ndarray]:
        """Group and level (words of the prefix that decides it) of each suffix."""
        bucket = _buckets(leaves.hashes(1))
        pieces = self.pieces[bucket]
        sub = (mix64(leaves.hashes(2)) % pieces.astype(_U)).astype(np.int64)
        return self.base[bucket] + np.where(pieces > 1, sub, 0), np.where(pieces > 1, 2, 1)


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - BUCKET_BITS)).astype(np.int64)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the task by the bucket of the prefix they begin."""
    sizes = np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        langs = batch.column(0).cast(pa.large_utf8())
        for part in slices(batch.column(1), SLICE):
            words, lang_names, columns = _coded(part, langs.slice(part.first, part.rows))[:3]
            if len(columns[0]):
                size = len(words) + 1
                stems, times = np.unique(columns[0].astype(np.int64) * size + columns[1], return_counts=True)
                leaves = Leaves(words, lang_names, [stems // size, stems % size])
                np.add.at(sizes, _buckets(leaves.hashes(1)), times)
    used = np.flatnonzero(sizes)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sizes[used])], ["bucket", "size"])


def _dealt(leaves: Leaves, group: np.ndarray, level: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    """(group, level, number of leaves, packed leaves) for each group that has any."""
    order = np.argsort(group, kind="stable")
    borders = np.flatnonzero(np.diff(group[order], prepend=-1))
    for start, end in zip(borders, [*borders[1:], len(order)], strict=True):
        rows = order[start:end]
        yield int(group[rows[0]]), int(level[rows[0]]), len(rows), leaves.packed(rows)


def _count(deal: Deal):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Leaves] = []

        def flushed() -> pa.RecordBatch:
            leaves = Leaves.joined(held)
            leaves = Leaves(leaves.words, leaves.langs, leaves.merged()[0])
            held.clear()
            return _batch(list(_dealt(leaves, *deal.groups(leaves))))

        for batch in batches:
            langs = batch.column(0).cast(pa.large_utf8())
            for part in slices(batch.column(1), SLICE):
                held += filter(len, [suffixes(part, langs.slice(part.first, part.rows))])
                if sum(map(len, held)) >= HELD:
                    yield flushed()
        if held:
            yield flushed()

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["part", "level", "size", "leaves"])


def _nodes(leaves: Leaves, level: int, least: int) -> pa.RecordBatch:
    """Nodes of one group; those of a depth that other groups share come with whatever count they have."""
    columns, begins = leaves.merged()
    running = np.concatenate([[0], np.cumsum(columns[4])])
    found = []
    for depth, start in enumerate(begins):
        f = running[np.append(start[1:], len(columns[4]))] - running[start]
        keep = np.ones(len(start), bool) if depth < 2 else columns[depth][start] > 0
        if depth and depth >= level:
            keep &= f >= least
        found.append((start[keep], f[keep]))
    rows = np.concatenate([start for start, _ in found])
    depth = np.concatenate([np.full(len(start), depth) for depth, (start, _) in enumerate(found)])
    names = pa.concat_arrays([pa.array([""], pa.large_utf8()), leaves.words])
    shown = [columns[1][rows] + 1, columns[2][rows], columns[3][rows]]
    return pa.RecordBatch.from_arrays(
        [
            leaves.langs.take(pa.array(columns[0][rows])).cast(pa.string()),
            *(names.take(pa.array(np.where(depth > at, column, 0))).cast(pa.string()) for at, column in enumerate(shown)),
            pa.array(depth.astype(np.int32)),
            pa.array(np.concatenate([f for _, f in found])),
            *(pa.nulls(len(rows), kind) for kind in (pa.int64(), pa.int32(), pa.int64(), pa.binary())),
        ],
        BUILT_NAMES,
    )


def _again(leaves: Leaves, part: int, level: int, turn: int) -> pa.RecordBatch:
    """Leaves of a group that is too large, to be dealt by one more word in the next turn."""
    level = min(level + 1, DEPTH)
    # each turn uses other bits than those that brought these prefixes together
    sub = (mix64(leaves.hashes(level) + _U(turn)) % _U(PIECES)).astype(np.int64)
    batch = _batch(list(_dealt(leaves, part * PIECES + sub, np.full(len(sub), level))))
    empty = [pa.nulls(batch.num_rows, kind) for kind in [pa.string()] * 4 + [pa.int32(), pa.int64()]]
    return pa.RecordBatch.from_arrays([*empty, *batch.columns], BUILT_NAMES)


def _build(least: int, budget: int, turn: int):
    """Builds the trees of the groups one after the other; rows come sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Leaves] = []
        now, divided = (None, 0), False

        def finished() -> Iterator[pa.RecordBatch]:
            if held:
                leaves = Leaves.joined(held)
                held.clear()
                yield _again(leaves, *now, turn) if divided else _nodes(leaves, now[1], least)

        for batch in batches:
            for part, level, _, data in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if (part, level) != now:
                    yield from finished()
                    now, divided = (part, level), False
                held.append(Leaves.unpacked(data))
                if sum(map(len, held)) > budget:
                    leaves = Leaves.joined(held)
                    leaves = Leaves(leaves.words, leaves.langs, leaves.merged()[0])
                    held[:] = [leaves]
                    # equal suffixes have become one; what is left is too much only if there are that many
                    if 2 * len(leaves) > budget:
                        held.clear()
                        divided = True
                        yield _again(leaves, part, level, turn)
        yield from finished()

    return run


def count_phrases(docs: DataFrame, least: int = LEAST, budget: int = BUDGET) -> DataFrame:
    """``lang, first, second, third, depth, f``: words and phrases of 2 and 3 words with f >= ``least``.

    ``f`` has all occurrences in ``docs(lang, text)``, overlapping ones too; unused places are empty texts. The row
    of depth 0 has all words of a language.
    """
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    sizes = np.zeros(1 << BUCKET_BITS, np.int64)
    # one number a bucket, whatever the size of the corpus
    for row in docs.mapInArrow(_sizes, "bucket long, size long").groupBy("bucket").agg(F.sum("size").alias("size")).collect():
        sizes[row.bucket] = row.size
    left = docs.mapInArrow(_count(Deal.packed(sizes, budget)), GROUPED)
    found, turn, more = [], 0, True
    while more:
        sorted_ = left.repartition("part").sortWithinPartitions("part", "level")
        built = stage(sorted_.mapInArrow(_build(least, budget, turn), f"{NODES}, {GROUPED}"), "phrase-nodes")
        found.append(built.where("leaves is null").select(*KEYS, "f"))
        left = built.where("leaves is not null").select("part", "level", "size", "leaves")
        turn, more = turn + 1, not left.isEmpty()
    nodes = reduce(DataFrame.unionAll, found)
    # a divided group has only its share of what shorter prefixes count
    return stage(nodes.groupBy(*KEYS).agg(F.sum("f").alias("f")).where((F.col("depth") == 0) | (F.col("f") >= least)), "phrases")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (l * r)), exact beyond 64 bits."""
    wide = {name: f"cast({name} as decimal(19, 0))" for name in (a, left, right)}
    return F.expr(f"cast((1000000 * {wide[a]} * {wide[a]}) div ({wide[left]} * {wide[right]}) as long)")


def collocations(
    docs: DataFrame, least: int = LEAST, reported: int = REPORTED, budget: int = BUDGET
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of 2 and 3 words of each language.

    Texts are lower-cased in A-Z and split at ``.,;:!?`` and line ends into pieces, and these at blanks and tabs into words.
    A phrase's weakest cut decides: ``l`` and ``r`` count its two sides, ``score`` is floor(1000000 * a * a / (l * r)).
    Phrases inside a longer one that has at least half of their occurrences are left out.

    NULL and empty texts have no words; a NULL lang is ``und``. Repeated rows count again. doc_id and other
    columns are not used. Equal scores and counts fall by the phrase's UTF-8 bytes. No words at all: no rows.
    """
    nodes = count_phrases(docs, least, budget)
    total = nodes.where("depth = 0").select("lang", F.col("f").alias("n"))
    common = nodes.where("depth = 1").select("lang", F.col("first").alias("word"), "f")
    pairs = nodes.where("depth = 2").select("lang", "first", "second", F.col("f").alias("a"))
    triples = nodes.where("depth = 3").select("lang", "first", "second", "third", F.col("f").alias("a"))

    def counted(frame: DataFrame, place: str, name: str) -> DataFrame:
        return frame.join(common.select("lang", F.col("word").alias(place), F.col("f").alias(name)), ["lang", place])

    def counted_pair(frame: DataFrame, one: str, two: str, name: str) -> DataFrame:
        side = pairs.select("lang", F.col("first").alias(one), F.col("second").alias(two), F.col("a").alias(name))
        return frame.join(side, ["lang", one, two])

    two = counted(counted(pairs, "first", "l"), "second", "r").withColumn("score", _score("a", "l", "r"))
    inner = triples.select("lang", "first", "second", "a").unionAll(triples.select("lang", "second", "third", "a"))
    inner = inner.groupBy("lang", "first", "second").agg(F.max("a").alias("longer"))
    two = two.join(inner, ["lang", "first", "second"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a"))
    )
    three = counted_pair(counted_pair(triples, "first", "second", "l2"), "second", "third", "r1")
    three = counted(counted(three, "first", "l1"), "third", "r2")
    three = three.withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang",
        F.concat_ws(" ", "first", "second", "third").alias("phrase"),
        "a",
        F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    two = two.select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a", "l", "r", "score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # each task passes on its own best first
    best = two.unionAll(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= reported)
    # one row a language
    return best.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
