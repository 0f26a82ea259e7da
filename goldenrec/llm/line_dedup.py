"""Fuzzy line de-duplication: block-wise SimHash of normalised lines, pigeonhole keys, edit similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.llm.columns import apart
from goldenrec.llm.links import star_groups
from goldenrec.llm.words import (
    ALNUM,
    LOWER,
    SMALL_SLICE_BYTES,
    Slice,
    cut,
    find_words,
    list_array,
    mix64,
    sequence_hash,
    signed,
    slices,
)
from goldenrec.session import stage

# Lines of fewer words are left alone: headings, blank lines, list marks. Scripts without spaces count by pieces.
LINE_WORDS = 3
# Lines link when their edit similarity holds.
EDIT_SIMILARITY = 0.85
# A line's distinct words are dealt to BLOCKS blocks by hash, each with a SimHash of its own words. A replaced
# word touches at most two blocks, an added or missing one a single block: EQUAL others stay as they are.
BLOCKS = 4
EQUAL = 2
BLOCK_BITS = 24
# Equal blocks must hold this many distinct words between them: fewer say nothing of a line.
EQUAL_WORDS = 3
# Bins of trigram counts, which bound the edit distance of a pair from below.
GRAM_BITS = 12
# Up to so many distinct words, each word is a block, and all blocks but one must be equal.
SHORT = 12
# Bits of the table that tells most documents without a wanted line from the others: 2 MB at any size of
# the corpus. Chance hits, more of them as it fills, only send documents through a join that finds nothing.
MARK_BITS = 24

_U = np.uint64
# Digits count as one sign, so that page numbers and dates do not make a line new.
FOLD = LOWER.copy()
FOLD[ord("0") : ord("9") + 1] = ord("0")

# Names used on the way; columns of the input that are called so are set aside.
OWN = ("version", "_id", "_version", "_gone", "_hit", "_word", "_bit", "_bits")
LINES = "doc_id long, version long, line int, id long, chars int, words int, blocks array<int>"
# Bits of a line's number within a slice, in the sorting of its words; a text has fewer lines of three words.
_LINE_BITS = 29


def _line_slice(part: Slice) -> tuple[Slice, np.ndarray, np.ndarray]:
    """The lines of all rows as a slice of their own, with (row, number within the row) of each."""
    # each line keeps its line feed, which is no part of any word
    breaks = np.flatnonzero(part.data == 0x0A)
    row_of_break = np.searchsorted(part.offsets, breaks, "right") - 1
    starts = np.concatenate([part.offsets[:-1], breaks + 1])
    rows = np.concatenate([np.arange(part.rows), row_of_break])
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    per_row = np.bincount(rows, minlength=part.rows)
    number = np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    return Slice(0, np.concatenate([starts, [len(part.data)]]), part.data), rows, number


def _simhash(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SimHash of BLOCK_BITS bits of consecutive, non-empty groups of word hashes."""
    found = np.zeros(len(starts), np.int64)
    size = np.diff(np.append(starts, len(hashes)))
    for byte in range(BLOCK_BITS // 8):
        bits = np.unpackbits((hashes >> _U(8 * byte)).astype(np.uint8)[:, None], axis=1, bitorder="little")
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        set_ = np.packbits(2 * ones > size[:, None], axis=1, bitorder="little")[:, 0]
        found |= set_.astype(np.int64) << (8 * byte)
    return found


def _piece_ends(data: np.ndarray) -> np.ndarray | None:
    """Bytes that end a piece of a script without spaces: after one in three of its characters.

    Which characters these are depends on themselves alone, so a changed one leaves all but its neighbours'
    pieces as they are. Characters of three or four bytes count as such a script.
    """
    if not (data >= 0xE0).any():
        return None
    inner = np.concatenate([[False, False], (data & 0xC0) == 0x80, [False]])
    last = inner[2:-1] & inner[1:-2] & ~inner[3:]
    return last & (data % 3 == 0)


def _blocks(line: np.ndarray, hashes: np.ndarray, lines: int) -> tuple[np.ndarray, pa.Array]:
    """Number of distinct words of each line, and its blocks.

    Blocks are one number per word up to SHORT words, then one per block from SHORT words on: its SimHash and, above
    it, its number of words, at most EQUAL_WORDS.
    """
    dealt = mix64(hashes)
    kind = (dealt >> _U(32)) % _U(BLOCKS)
    key = np.sort((line.astype(_U) << _U(64 - _LINE_BITS)) | (kind << _U(32)) | (dealt & _U(0xFFFFFFFF)))
    # sorted, equal words of a line stand side by side
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    group = key >> _U(32)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(key) else np.zeros(0, np.int64)
    owner = (key >> _U(64 - _LINE_BITS)).astype(np.int64)
    count = np.bincount(owner, minlength=lines)
    size = np.diff(np.append(starts, len(key)))
    whole = np.zeros((lines, BLOCKS), np.int64)
    if len(key):
        place = (group[starts] & _U(7)).astype(np.int64)
        sims = _simhash(mix64(key & _U((1 << 35) - 1)), starts)
        whole[owner[starts], place] = sims | (np.minimum(size, EQUAL_WORDS) << BLOCK_BITS)
    singles = np.where(count <= SHORT, count, 0)
    lengths = singles + np.where(count >= SHORT, BLOCKS, 0)
    begin = np.cumsum(lengths) - lengths
    values = np.zeros(int(lengths.sum()), np.int32)
    rank = np.arange(len(key)) - np.repeat(np.cumsum(count) - count, count)
    short = count[owner] <= SHORT
    values[(begin[owner] + rank)[short]] = key[short].astype(np.uint32).view(np.int32)
    long_ = np.flatnonzero(count >= SHORT)
    values[(begin + singles)[long_][:, None] + np.arange(BLOCKS)] = whole[long_]
    return count, list_array(lengths, pa.array(values))


def _read_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place, identity (hash of the normalised words), length and blocks of every line of enough words."""
    for batch in batches:
        for part in slices(batch.column(2), SMALL_SLICE_BYTES):
            lines, rows, number = _line_slice(part)
            words = find_words(lines, ALNUM, FOLD)
            ends = _piece_ends(lines.data)
            pieces = words if ends is None else find_words(lines, ALNUM, FOLD, ends)
            enough = pieces.count >= LINE_WORDS
            wanted = np.flatnonzero(enough)
            hashes = words.hash[np.repeat(enough, words.count)]
            count = words.count[wanted]
            starts = np.cumsum(count) - count
            sums = np.zeros(len(hashes) + 1, _U)
            place = np.arange(len(hashes)) - np.repeat(starts, count)
            turn = hashes * (_U(2) * place.astype(_U) + _U(0x9E3779B97F4A7C15))
            np.cumsum(turn ^ (turn >> _U(29)), out=sums[1:])
            ids = sequence_hash(sums[starts + count] - sums[starts] + count.astype(_U), 1)
            # code points of the words and the spaces between them
            points = np.concatenate([[0], np.cumsum((lines.data & 0xC0) != 0x80)])
            sizes = np.bincount(words.row, points[words.end] - points[words.start], len(enough)).astype(np.int64)
            chars = (sizes + words.count - 1)[wanted]
            held = np.repeat(enough, pieces.count)
            fresh = np.cumsum(enough) - 1
            distinct, blocks = _blocks(fresh[pieces.row[held]], pieces.hash[held], len(wanted))
            own = pa.array(rows[wanted])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(part.first, part.rows).take(own),
                    batch.column(1).slice(part.first, part.rows).take(own),
                    pa.array(number[wanted].astype(np.int32)),
                    pa.array(signed(ids)),
                    pa.array(chars.astype(np.int32)),
                    pa.array(distinct.astype(np.int32)),
                    blocks,
                ],
                ["doc_id", "version", "line", "id", "chars", "words", "blocks"],
            )


def _block_keys(words: Column, blocks: Column) -> Column:
    """One key per choice of blocks that may all be equal.

    Lines of up to SHORT words: all words, and from four words on all but one of them. Longer ones: EQUAL
    of the blocks. Lines of just SHORT words have both, to meet those with a word more or less.
    """
    each = F.transform(F.slice(blocks, 1, words), lambda word: F.xxhash64(word))
    every = F.aggregate(each, F.lit(0).cast("long"), lambda total, one: total.bitwiseXOR(one))
    alone = F.when(words <= EQUAL_WORDS, F.array(every)).otherwise(
        F.concat(F.array(every), F.transform(each, lambda one: every.bitwiseXOR(one)))
    )
    first = F.when(words == SHORT, SHORT).otherwise(0)
    several = []
    for number, chosen in enumerate(combinations(range(BLOCKS), EQUAL)):
        parts = [F.get(blocks, first + place) for place in chosen]
        held = sum((F.shiftright(part, BLOCK_BITS) for part in parts), F.lit(0))
        several.append(F.when(held >= EQUAL_WORDS, F.xxhash64(F.lit(number), *parts)))
    several = F.array_compact(F.array(*several))
    return F.when(words < SHORT, alone).when(words > SHORT, several).otherwise(F.concat(alone, several))


def normalised(line: Column) -> Column:
    """Lower-cased words with digits as one sign, joined by one space."""
    lower = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")
    return F.trim(F.regexp_replace(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _allowed(longest: Column) -> Column:
    """Edits that two lines may be apart, the longer of so many characters."""
    return F.floor(longest * F.lit(1 - EDIT_SIMILARITY)).cast("int")


def _same_start(left: str, right: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(left), len(right))
    while low < high:
        middle = (low + high + 1) // 2
        if left[low:middle] == right[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _grams(text: str) -> np.ndarray:
    """Counts of the text's trigrams, in 2**GRAM_BITS bins."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    grams = (points[:-2] * np.uint32(0x9E3779B1) ^ points[1:-1] * np.uint32(0x85EBCA77)) + points[2:] * np.uint32(0xC2B2AE3D)
    return np.bincount(grams >> np.uint32(32 - GRAM_BITS), minlength=1 << GRAM_BITS)


def _too_far(left: str, right: str, allowed: int) -> bool:
    """Whether the trigrams alone show more edits: each changes at most three on either side."""
    if min(len(left), len(right)) < 64:
        return False
    return int(np.abs(_grams(left) - _grams(right)).sum()) > 6 * allowed


def _near(left: str, right: str, allowed: int) -> bool:
    """Whether one alignment of the words, not always the best, needs no more edits than allowed."""
    a, b = left.split(" "), right.split(" ")
    i = j = total = 0
    while i < len(a) and j < len(b) and total <= allowed:
        if a[i] == b[j]:
            i, j = i + 1, j + 1
        elif i + 1 < len(a) and a[i + 1] == b[j]:
            total, i = total + len(a[i]) + 1, i + 1
        elif j + 1 < len(b) and a[i] == b[j + 1]:
            total, j = total + len(b[j]) + 1, j + 1
        else:
            total, i, j = total + max(len(a[i]), len(b[j])), i + 1, j + 1
    return total + sum(len(word) + 1 for word in a[i:] + b[j:]) <= allowed


def _cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of lines without what they begin and end alike with, which takes no edit, and the edits allowed to all.

    Pairs that a simple alignment shows to be near enough come without any text, those that their trigrams show to be
    too far apart not at all.
    """
    for batch in batches:
        for part in cut(batch, [2, 3], SMALL_SLICE_BYTES):
            kept, lefts, rights, bounds = [], [], [], []
            for place, (left, right) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                allowed = math.floor(max(len(left), len(right)) * (1 - EDIT_SIMILARITY))
                first = _same_start(left, right)
                left, right = left[first:], right[first:]
                last = _same_start(left[::-1], right[::-1])
                left, right = left[: len(left) - last], right[: len(right) - last]
                if _near(left, right, allowed):
                    left = right = ""
                if not _too_far(left, right, allowed):
                    kept.append(place)
                    lefts.append(left)
                    rights.append(right)
                    bounds.append(allowed)
            ids = part.select([0, 1]).take(pa.array(kept, pa.int64()))
            cores = [pa.array(lefts, pa.string()), pa.array(rights, pa.string()), pa.array(bounds, pa.int32())]
            yield pa.RecordBatch.from_arrays([*ids.columns, *cores], ["a", "b", "left", "right", "allowed"])


def _similar(left: Column, right: Column, allowed: Column) -> Column:
    """Whether the edits are allowed: the bounded form fills a band of the table only and gives -1 beyond it."""
    # a narrow band settles most pairs that are similar
    return F.coalesce(*(
        F.when(F.call_function("levenshtein", left, right, bound) >= 0, True)
        for bound in (F.shiftright(allowed, 4), F.shiftright(allowed, 2), allowed)
    ), F.lit(False))


def _text_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _spot(frame: DataFrame) -> DataFrame:
    """Adds the word and the bit of a document's mark."""
    mark = F.pmod(F.xxhash64("doc_id", "version"), F.lit(1 << MARK_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (mark % 64).cast("int"))
    return frame.withColumns({"_word": F.floor(mark / 64), "_bit": bit})


def _marks(keys: DataFrame) -> DataFrame:
    """Marks of the documents ``keys(doc_id, version)``: at most 2**18 rows of 64 bits."""
    return _spot(keys).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def _marked(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``docs(doc_id, version, ...)`` plus ``_hit``: false is certain, true may be chance."""
    # bounded by MARK_BITS however large the corpus is
    joined = _spot(docs).join(F.broadcast(marks), "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False))
    return joined.withColumn("_hit", hit).drop("_word", "_bit", "_bits")


def _members(lines: DataFrame) -> DataFrame:
    """``bucket, id`` of all keys, dealt by bucket: one exchange for the ranges of the buckets and the join after them.

    Neither is ever NULL, but Spark cannot know: the join alone would ask for the id, and shuffle rows of its own.
    """
    keys = _block_keys(F.col("words"), F.col("blocks"))
    members = lines.select(F.explode(keys).alias("bucket"), "id")
    return members.where(F.col("bucket").isNotNull() & F.col("id").isNotNull()).repartition("bucket")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` rid of repeated lines, plus ``n_lines, n_removed``.

    Lines are cut at line feeds. Normalised, equal lines are one; two different ones link when their edit similarity,
    1 - distance / longer length, is 0.85 or more and they share a key: two of four blocks of distinct words with
    equal SimHashes, or all words but one where there are at most 12. So a word replaced, added or left out is always
    found if the rest is equal words, save where the equal blocks hold fewer than three of them or a line has at most
    three distinct words, which must then be the same; lines that differ in more words are found by chance, the
    oftener the fewer they are. Links are found by joining on the keys in star
    rounds (``links.star_groups``). Of each connected group the occurrence with the smallest (doc_id, line
    number) stays in the whole table; all others go. Lines of fewer than 3 words always stay; runs of characters
    of three and more UTF-8 bytes are cut into pieces of some three characters, each of which counts as a word. Only
    documents that lose a line, and those whose lines are compared, are shuffled with their text. Equal lines
    are told by a 64-bit hash of their words.

    NULL text: no lines, stays NULL. NULL doc_id: comes before all ids. Rows repeating doc_id and text
    are one document and get the same result. Other columns pass through; ``n_lines`` and
    ``n_removed`` of the input are replaced.
    """
    docs, restored = apart(docs.drop("n_lines", "n_removed"), OWN)
    version = F.xxhash64("text")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), version.alias("version"), "text")
    seen = stage(source.mapInArrow(_read_lines, LINES), "lines")
    place = F.struct("doc_id", "version", "line")
    # all lines of one id have the same words, so any stands for them
    lines = seen.groupBy("id").agg(
        F.min(place).alias("first"),
        F.count(F.lit(1)).alias("n"),
        *(F.first(name).alias(name) for name in ("chars", "words", "blocks")),
    )
    lines = stage(lines, "distinct-lines")
    members = _members(lines)
    texts: list[DataFrame] = []

    def prepare(ids: DataFrame) -> None:
        """The normalised texts of all candidates, stored once."""
        wanted = lines.join(ids, "id", "left_semi").select("id", "first.*").groupBy("doc_id", "version").agg(
            F.collect_list(F.struct("line", "id")).alias("wanted")
        )
        wanted = stage(wanted, "wanted-lines")
        holders = _marked(source, _marks(wanted)).where("_hit")
        wanted = wanted.withColumnsRenamed({"doc_id": "_id", "version": "_version"})
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version"))
        held = holders.join(wanted, same).select("wanted", _text_lines(F.col("text")).alias("cut"))
        each = F.transform(
            "wanted", lambda one: F.struct(one["id"].alias("id"), F.get("cut", one["line"]).alias("text"))
        )
        found = held.select(F.explode(each).alias("one")).select("one.id", normalised(F.col("one.text")).alias("text"))
        texts.append(stage(found.dropDuplicates(["id"]), "line-texts"))

    def confirm(pairs: DataFrame) -> DataFrame:
        left = texts[0].select(F.col("id").alias("a"), F.col("text").alias("left"))
        right = texts[0].select(F.col("id").alias("b"), F.col("text").alias("right"))
        joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        joined = joined.mapInArrow(_cores, "a long, b long, left string, right string, allowed int")
        return joined.where(_similar(F.col("left"), F.col("right"), F.col("allowed"))).select("a", "b")

    def close(one: Column, other: Column) -> Column:
        return F.abs(one - other) <= _allowed(F.greatest(one, other))

    groups, _ = star_groups(members, lines.select("id", F.col("chars").alias("info")), close, confirm, prepare)
    grouped = lines.join(groups, "id", "left").where((F.col("n") > 1) | F.col("component").isNotNull())
    grouped = grouped.withColumn("component", F.coalesce("component", "id"))
    heads = grouped.groupBy("component").agg(F.min("first").alias("head"))
    decided = grouped.join(heads, "component").select("id", "head")
    gone = (
        seen.join(decided, "id")
        .where(~place.eqNullSafe(F.col("head")))
        .groupBy("doc_id", "version")
        .agg(F.array_distinct(F.collect_list("line")).alias("_gone"))
    )
    gone = stage(gone, "repeated-lines")
    kept = docs.withColumn("version", version)
    kept = _marked(kept.withColumn("doc_id", F.col("doc_id").cast("long")), _marks(gone))
    gone = gone.withColumnsRenamed({"doc_id": "_id", "version": "_version"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version"))
    touched = kept.where("_hit").join(gone, same, "left").drop("_id", "_version")
    # documents that lose nothing stay where they are
    whole = kept.where(~F.col("_hit")).withColumn("_gone", F.lit(None).cast("array<int>"))
    joined = touched.unionByName(whole)
    removed = F.coalesce("_gone", F.array().cast("array<int>"))
    all_lines = _text_lines(F.col("text"))
    rest = F.filter(all_lines, lambda line, number: ~F.array_contains(removed, number))
    text = F.when(F.size(removed) > 0, F.array_join(rest, "\n")).otherwise(F.col("text"))
    result = joined.withColumns(
        {
            "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(all_lines)).cast("long"),
            "n_removed": F.size(removed).cast("long"),
            "text": text,
        }
    )
    return restored(result.drop("_gone", "_hit", "version"))
