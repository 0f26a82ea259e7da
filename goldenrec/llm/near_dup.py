"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.llm.links import star_groups
from goldenrec.llm.words import (
    LOWER,
    SMALL_SLICE_BYTES,
    SPACED,
    Slice,
    cut,
    find_words,
    list_array,
    mix64,
    row_starts,
    sequence_hash,
    signed,
    slices,
    windows,
)
from goldenrec.session import stage

SHINGLE_WORDS = 5
# A pair links when 100 * intersection >= SIMILAR * union.
SIMILAR = 75
# 32 bands of 4: a pair at similarity 0.75 shares no band with probability (1 - 0.75**4)**32 = 5e-6.
BANDS = 32
BAND_ROWS = 4
BINS = BANDS * BAND_ROWS
# Probes of an empty bin before the next filled one is taken; one filled bin of 128 needs 128 on average.
PROBES = 2048
# Parts of the shingles, by hash, in which two members of a large bucket are compared by counts.
PARTS = 32

SIGNED = "doc_id long, n_shingles long, node long, bands array<long>, version long"

_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


def _probe_table() -> np.ndarray:
    """Bin that an empty bin looks at in each attempt: one hash for all documents."""
    attempt, place = np.meshgrid(np.arange(PROBES, dtype=_U), np.arange(BINS, dtype=_U), indexing="ij")
    return (mix64(attempt * _U(BINS) + place + _U(0x5EED)) >> _U(57)).astype(np.int64)


def shingle_sets(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of every row, sorted by row and then hash.

    Rows of one to four words have their whole sequence as the only shingle.
    """
    words = find_words(part, SPACED, LOWER)
    first, hashes = windows(words, SHINGLE_WORDS)
    rows = [words.row[first]]
    values = [hashes]
    starts = row_starts(words)
    for size in range(1, SHINGLE_WORDS):
        short = np.flatnonzero(words.count == size)
        if len(short):
            rows.append(short)
            values.append(mix64(sequence_hash(words.hash, size)[starts[short]] + _U(size)))
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[fresh], value[fresh]


def _densified(row: np.ndarray, value: np.ndarray, rows: int, probe: np.ndarray) -> np.ndarray:
    """Smallest hash in each bin of each row; an empty bin takes that of the first filled bin it probes."""
    place = (value >> _U(57)).astype(np.int64)
    table = np.full((rows, BINS), _EMPTY, _U)
    key = row * BINS + place
    least = np.ones(len(key), bool)
    least[1:] = key[1:] != key[:-1]
    table.reshape(-1)[key[least]] = value[least]
    filled = table != _EMPTY
    open_row, open_bin = np.nonzero(~filled)
    done = table.copy()
    for attempt in range(PROBES):
        if not len(open_row):
            break
        source = probe[attempt][open_bin]
        hit = filled[open_row, source]
        done[open_row[hit], open_bin[hit]] = table[open_row[hit], source[hit]]
        open_row, open_bin = open_row[~hit], open_bin[~hit]
    if len(open_row):
        done[open_row, open_bin] = table[open_row, filled[open_row].argmax(axis=1)]
    return done


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    probe = _probe_table()
    lanes = mix64(np.arange(1, BANDS + 1, dtype=_U))
    for batch in batches:
        for part in slices(batch.column(1), SMALL_SLICE_BYTES):
            row, value = shingle_sets(part)
            size = np.bincount(row, minlength=part.rows)
            have = np.flatnonzero(size)
            node = np.zeros(part.rows, _U)
            bands = np.zeros(0, _U)
            if len(have):
                starts = np.concatenate([[0], np.cumsum(size[have])[:-1]])
                node[have] = mix64(np.add.reduceat(mix64(value ^ _U(0xA5A5A5A5)), starts) + size[have].astype(_U))
                table = _densified(np.repeat(np.arange(len(have)), size[have]), value, len(have), probe)
                lane = table.reshape(len(have), BANDS, BAND_ROWS)
                bands = np.zeros((len(have), BANDS), _U)
                for column in range(BAND_ROWS):
                    bands = mix64(bands + lane[:, :, column] + lanes[None, :])
                bands = bands.reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(part.first, part.rows),
                    pa.array(size.astype(np.int64)),
                    pa.array(signed(node), mask=size == 0),
                    list_array(np.where(size > 0, BANDS, 0), pa.array(signed(bands))),
                    batch.column(2).slice(part.first, part.rows),
                ],
                ["doc_id", "n_shingles", "node", "bands", "version"],
            )


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text has the wanted node (a doc_id may stand for several texts)."""
    for batch in batches:
        wanted = np.asarray(batch.column(0))
        for part in slices(batch.column(1), SMALL_SLICE_BYTES):
            row, value = shingle_sets(part)
            size = np.bincount(row, minlength=part.rows)
            have = np.flatnonzero(size)
            node = np.zeros(part.rows, _U)
            if len(have):
                starts = np.concatenate([[0], np.cumsum(size[have])[:-1]])
                node[have] = mix64(np.add.reduceat(mix64(value ^ _U(0xA5A5A5A5)), starts) + size[have].astype(_U))
            same = (signed(node) == wanted[part.first : part.first + part.rows]) & (size > 0)
            yield batch.slice(part.first, part.rows).filter(pa.array(same))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full shingle sets are similar enough."""
    for batch in batches:
        for part in cut(batch, [2, 3], SMALL_SLICE_BYTES):
            both = np.concatenate([shingle_rows(part.column(2)), shingle_rows(part.column(3))])
            both = both[np.lexsort((both[:, 1], both[:, 0]))]
            twice = (both[1:] == both[:-1]).all(axis=1)
            shared = np.bincount(both[1:][twice][:, 0].astype(np.int64), minlength=part.num_rows)
            total = np.bincount(both[:, 0].astype(np.int64), minlength=part.num_rows)
            similar = 100 * shared >= SIMILAR * (total - shared)
            yield part.select([0, 1]).filter(pa.array(similar))


def _view(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of a text by part: those that its centre has, then those that neither this nor any other text alone has.

    ``same`` and ``beside`` count them over all parts. A part's counts of two texts bound what they can have in common in it.
    """
    for batch in batches:
        for part in cut(batch, [2, 3], SMALL_SLICE_BYTES):
            rows = part.num_rows
            mine = shingle_rows(part.column(2))
            both = np.concatenate([mine, shingle_rows(part.column(3))])
            both = both[np.lexsort((both[:, 1], both[:, 0]))]
            shared = both[1:][(both[1:] == both[:-1]).all(axis=1)]
            same, rest = _by_part(shared, rows), _by_part(mine, rows)
            rest -= same
            own = part.column(4)
            known = np.flatnonzero(np.asarray(own.is_valid()))
            if len(known):
                rest[known] -= np.asarray(own.drop_null().flatten()).reshape(-1, PARTS)
            # the centre's own shingles are among those that it has
            rest = np.maximum(rest, 0)
            counts = np.concatenate([same, rest], axis=1).astype(np.int32).reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(same.sum(axis=1)),
                    pa.array(rest.sum(axis=1)),
                    list_array(np.full(rows, 2 * PARTS), pa.array(counts)),
                ],
                ["centre", "id", "same", "beside", "parts"],
            )


def _by_part(found: np.ndarray, rows: int) -> np.ndarray:
    """Shingles of each row in each part."""
    place = found[:, 0] * _U(PARTS) + found[:, 1] % _U(PARTS)
    return np.bincount(place.astype(np.int64), minlength=rows * PARTS).reshape(rows, PARTS)


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct shingle of each text."""
    for batch in batches:
        for part in cut(batch, [1], SMALL_SLICE_BYTES):
            both = shingle_rows(part.column(1))
            node = part.column(0).take(pa.array(both[:, 0].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(signed(both[:, 1])), node], ["shingle", "node"])


def shingle_rows(column: pa.Array) -> np.ndarray:
    """(row of the batch, shingle hash) of every distinct shingle."""
    found = [np.zeros((0, 2), _U)]
    for part in slices(column, SMALL_SLICE_BYTES):
        row, value = shingle_sets(part)
        found.append(np.stack([(row + part.first).astype(_U), value], axis=1))
    return np.concatenate(found)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, version`` for every row of ``docs(doc_id, text)``.

    Two texts link when the sets of their distinct lower-cased 5-word shingles (64-bit hashes) have
    100 * intersection >= 75 * union; texts of one to four words have one shingle, the whole sequence.
    Texts with equal sets are one node, so copies never form pairs. Nodes that share a MinHash band
    are candidates, in star rounds (``links.star_groups``), and each candidate is confirmed on the full
    sets. ``component_id`` is the smallest doc_id reachable; ``kept`` marks the row that has it.

    NULL, empty or blank text: no shingles, linked with nothing, kept. NULL doc_id: takes part, counts
    as no id; one text of a group without any id is kept. Rows repeating a doc_id are judged by their own
    text, told apart by its hash ``version``. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed_docs = docs.select("doc_id", "text", F.xxhash64("text").alias("version")).mapInArrow(_sign, SIGNED)
    signed_docs = stage(signed_docs, "minhash")
    nodes = signed_docs.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("first"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    nodes = stage(nodes, "minhash-nodes")
    members = nodes.select(F.explode("bands").alias("bucket"), F.col("node").alias("id"))
    infos = nodes.select(F.col("node").alias("id"), F.struct("n", F.lit(0).cast("long").alias("own")).alias("info"))
    texts: list[DataFrame] = []
    owned: list[DataFrame] = []

    def prepare(ids: DataFrame) -> None:
        """The texts of all candidates, one per node, stored once."""
        wanted = nodes.select("node", "first").join(ids.withColumnRenamed("id", "node"), "node", "left_semi")
        # NULL ids meet each other too
        here = docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("first"), "text")
        found = here.join(wanted.withColumn("first", F.coalesce("first", F.lit(-(2**63)))), "first")
        picked = found.select("node", "text").mapInArrow(_pick, "node long, text string")
        texts.append(stage(picked.dropDuplicates(["node"]), "minhash-texts"))

    def confirm(pairs: DataFrame) -> DataFrame:
        left = texts[0].select(F.col("node").alias("a"), F.col("text").alias("left"))
        right = texts[0].select(F.col("node").alias("b"), F.col("text").alias("right"))
        joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        return joined.mapInArrow(_compare, "a long, b long")

    def close(one: Column, other: Column) -> Column:
        """No pair can share more than either has in common with any other text."""
        return enough(one, other, F.least(one["n"] - one["own"], other["n"] - other["own"]))

    def enough(one: Column, other: Column, common: Column) -> Column:
        return 100 * common >= SIMILAR * (one["n"] + other["n"] - common)

    def closer(one: Column, other: Column) -> Column:
        """Nor more than either has in common with the centre plus more than either shares with others beside it.

        The same holds in every part of the shingles, and so for the sum over the parts.
        """
        mine, theirs = one["view"], other["view"]
        whole = F.least(mine["same"], theirs["same"]) + F.least(mine["beside"], theirs["beside"])
        least = F.zip_with(mine["parts"], theirs["parts"], lambda left, right: F.least(left, right))
        parts = F.aggregate(least, F.lit(0), lambda total, part: total + part)
        possible = enough(one, other, whole) & enough(one, other, parts)
        return close(one, other) & F.coalesce(possible, F.lit(True))

    def refine(ids: DataFrame) -> DataFrame:
        """Info with the number of shingles that no other of these texts has."""
        left = texts[0].join(ids.withColumnRenamed("id", "node"), "node", "left_semi").select("node", "text")
        alone = left.mapInArrow(_spell, "shingle long, node long").groupBy("shingle").agg(
            F.count(F.lit(1)).alias("nodes"), F.min("node").alias("id")
        )
        part = F.pmod("shingle", F.lit(PARTS))
        spread = F.array(*[F.count_if(part == place).cast("int") for place in range(PARTS)])
        alone = alone.where("nodes = 1").groupBy("id").agg(F.count(F.lit(1)).alias("own"), spread.alias("spread"))
        owned.append(stage(alone, "minhash-owned"))
        alone = owned[0].select("id", "own")
        sized = ids.join(nodes.select(F.col("node").alias("id"), "n"), "id").join(alone, "id", "left")
        return sized.select("id", F.struct("n", F.coalesce("own", F.lit(0).cast("long")).alias("own")).alias("info"))

    def relate(stars: DataFrame) -> DataFrame:
        mine = texts[0].withColumnRenamed("node", "id")
        centre = texts[0].select(F.col("node").alias("centre"), F.col("text").alias("other"))
        joined = stars.join(mine, "id").join(centre, "centre").join(owned[0].select("id", "spread"), "id", "left")
        seen = joined.select("centre", "id", "text", "other", "spread").mapInArrow(
            _view, "centre long, id long, same long, beside long, parts array<int>"
        )
        return seen.select("centre", "id", F.struct("same", "beside", "parts").alias("view"))

    groups, _ = star_groups(
        members, infos, close, confirm, prepare, refine, lambda info: info["own"], relate, closer
    )
    grouped = nodes.select("node", "first").join(groups.withColumnRenamed("id", "node"), "node", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "node"))
    # an id comes before none; without any id the smallest node stands for the group
    order = F.struct(F.col("first").isNull(), F.col("first").alias("id"), F.col("node").alias("node"))
    heads = grouped.groupBy("component").agg(F.min(order).alias("head"))
    by_node = grouped.join(heads, "component").select("node", F.col("head.id").alias("component_id"), F.col("head.node").alias("head"))
    mine = F.when(F.col("doc_id").isNull(), F.col("component_id").isNull() & (F.col("node") == F.col("head"))).otherwise(
        F.col("doc_id") == F.col("component_id")
    )
    alone = F.col("node").isNull()
    return signed_docs.drop("bands").join(by_node, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.lit(True)).otherwise(F.coalesce(mine, F.lit(False))).alias("kept"),
        "version",
    )
