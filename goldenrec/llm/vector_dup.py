"""Near-duplicate vectors by collision counting on many one-dimensional projections.

A vector is kept as its projections on random orthonormal axes, rounded to a byte each. Two vectors collide on a
projection if one lies in the window around the other; pairs with enough collisions are verified. Windows and the
needed count are calibrated so that nearly all pairs at the wanted cosine pass. Only vectors that are dealt to the
same cell in one of several tables are counted against each other; a cell is a choice of extreme projections, and the
number of tables follows from the chance that a pair at the wanted cosine shares a cell.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenrec.llm.links import Scratch, components
from goldenrec.llm.words import mix64, signed
from goldenrec.session import stage

COSINE = 0.9
# Least share of the pairs at exactly COSINE that share a cell, and of these that pass the count.
CELL_RECALL = 0.97
COUNT_RECALL = 0.99
# Least number of projections whose collisions are counted.
PROJECTIONS = 64
# Half a window, in standard deviations of a projected difference at COSINE.
WINDOW = 2.0
# Distinct vectors wanted in a cell by chance; more of them make cells of one more choice.
CELL_SIZE = 64
# Axes that a choice is made of.
AXES = 64
# Members of a shard; a larger cell becomes tiles of two shards each.
SHARD = 1024
# Pairs counted at once.
PAIRS = 1 << 18
# Projections that are counted for all pairs of a tile before hopeless ones are left out.
LEAD = 16
# Pairs at exactly COSINE that calibrate: made up, so no data set decides.
CALIBRATION = 4000
SEED = 12

SKETCHED = "vec_id long, key binary, dim int, sketch binary, step double, off double"
CELL = "dim int, tab int, cell long"
DEALT = f"{CELL}, id long, copies long, sketch binary, step double, off double"
FOUND = "a long, b long, n long"
# ``n`` of a found row that is no count.
EDGE, CHECK = 0, -1

_U = np.uint64


class Plan(NamedTuple):
    """Parameters for vectors of one dimension, the same in every task."""

    blocks: int  # orthonormal blocks of projections
    turns: np.ndarray  # tables x choices x projections x axes, whole numbers
    half: float  # half a window
    need: int  # collisions of a pair that is verified
    recall: float  # of pairs at exactly COSINE


def _sketch(units: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Projections in whole steps, the step, and how far the rounded vector is off at most."""
    spots = units @ axes
    step = np.maximum(np.abs(spots).max(axis=1), 1e-300) / 127
    sketch = np.rint(spots / step[:, None]).astype(np.int8)
    off = np.sqrt(((spots - sketch * step[:, None]) ** 2).sum(axis=1))
    return sketch, step, off


def _cells(sketch: np.ndarray, turns: np.ndarray, table: int) -> np.ndarray:
    """Cell of each vector in a table: per choice, the axis on which it is farthest out, and the side.

    Whole numbers below 2**53 are multiplied and added, so every task finds the same.
    """
    values = sketch.astype(np.float64)
    total = np.full(len(values), _U(table + 1))
    for turn in turns[table]:
        spots = values @ turn.astype(np.float64)
        axis = np.abs(spots).argmax(axis=1)
        side = spots[np.arange(len(spots)), axis] < 0
        total = mix64(total * _U(31) + (2 * axis + side).astype(_U))
    return signed(total)


def _axes(dim: int) -> np.ndarray:
    """Projections of ``dim`` components, orthonormal in blocks of ``dim``."""
    random = np.random.default_rng((SEED, dim))
    blocks = -(-PROJECTIONS // dim)
    return np.concatenate([np.linalg.qr(random.standard_normal((dim, dim)))[0] for _ in range(blocks)], axis=1)


def make_plan(dim: int, vectors: int, cosine: float = COSINE) -> Plan:
    """Tables, windows and the needed count for ``vectors`` distinct vectors of ``dim`` components."""
    random = np.random.default_rng(SEED)
    axes = _axes(dim)
    wide = min(dim, AXES)
    choices = max(1, round(math.log(max(vectors / CELL_SIZE, 1)) / math.log(2 * wide)))
    one = random.standard_normal((CALIBRATION, dim))
    one /= np.sqrt((one**2).sum(axis=1, keepdims=True))
    aside = random.standard_normal((CALIBRATION, dim))
    aside -= (aside * one).sum(axis=1, keepdims=True) * one
    length = np.sqrt((aside**2).sum(axis=1, keepdims=True))
    aside = np.divide(aside, length, out=np.zeros_like(aside), where=length > 1e-9)
    other = cosine * one + math.sqrt(1 - cosine**2) * aside
    (left, left_step, _), (right, right_step, _) = _sketch(one, axes), _sketch(other, axes)
    half = WINDOW * math.sqrt(2 * (1 - cosine) / dim)
    apart_ = np.abs(left * left_step[:, None] - right * right_step[:, None])
    hits = np.sort((apart_ <= half).sum(axis=1))
    need = int(hits[int((1 - COUNT_RECALL) * len(hits))])
    turns, missed = [], np.ones(CALIBRATION, bool)
    while missed.mean() > 1 - CELL_RECALL:
        turns.append(np.rint(random.standard_normal((choices, axes.shape[1], wide)) * 256))
        table = len(turns) - 1
        missed &= _cells(left, turns, table) != _cells(right, turns, table)
    found = ~missed & ((apart_ <= half).sum(axis=1) >= need)
    return Plan(axes.shape[1] // dim, np.stack(turns).astype(np.int16), half, need, float(found.mean()))


def _usable(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, unit vectors) of vectors without NULL or non-finite parts and not zero, by dimension."""
    size = np.asarray(column.value_lengths().fill_null(0))
    values = column.flatten().cast(pa.float64())
    bad = np.asarray(values.is_null()) | ~np.isfinite(np.asarray(values.fill_null(0)))
    values = np.asarray(values.fill_null(0))
    ends = np.cumsum(size)
    worse = np.concatenate([[0], np.cumsum(bad)])
    whole = (size > 0) & (worse[ends] == worse[ends - size])
    for dim in np.unique(size[whole]).tolist():
        rows = np.flatnonzero(whole & (size == dim))
        vectors = values[(ends - size)[rows][:, None] + np.arange(dim)]
        longest = np.abs(vectors).max(axis=1)
        rows, vectors, longest = rows[longest > 0], vectors[longest > 0], longest[longest > 0]
        # scaled first, so that squares of huge or tiny components stay finite
        vectors = vectors / longest[:, None]
        yield dim, rows, vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and sketch of every usable vector; the others come without."""
    axes: dict[int, np.ndarray] = {}
    for batch in batches:
        rows = batch.num_rows
        keys, sketches = np.full(rows, None), np.full(rows, None)
        dims, step, off = np.zeros(rows, np.int32), np.zeros(rows), np.zeros(rows)
        vectors = batch.column(1)
        for dim, at, units in _usable(vectors):
            if dim not in axes:
                axes[dim] = _axes(dim)
            sketch, step[at], off[at] = _sketch(units, axes[dim])
            dims[at] = dim
            sketches[at] = [row.tobytes() for row in sketch]
            # adding 0 makes both zeros one
            given = np.asarray(vectors.take(pa.array(at)).flatten().cast(pa.float64())).reshape(len(at), dim) + 0.0
            keys[at] = [hashlib.md5(row.tobytes(), usedforsecurity=False).digest() for row in given]
        known = np.asarray(batch.column(0).is_valid())
        none = ~known | (dims == 0)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.where(none, None, keys), pa.binary()),
                pa.array(dims),
                pa.array(np.where(none, None, sketches), pa.binary()),
                pa.array(step),
                pa.array(off),
            ],
            ["vec_id", "key", "dim", "sketch", "step", "off"],
        )


def _signs(column: pa.Array) -> np.ndarray:
    """Equally long binary values as rows of signed bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(len(column), -1)


def _deal(plans: dict[int, Plan], whole: bool):
    """A row per vector and table with its cell; only the cells themselves unless ``whole``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                sketch = _signs(rows.column("sketch"))
                for table in range(len(plans[dim].turns)):
                    count = rows.num_rows
                    names = [pa.array(np.full(count, dim, np.int32)), pa.array(np.full(count, table, np.int32))]
                    names.append(pa.array(_cells(sketch, plans[dim].turns, table)))
                    rest = ["id", "copies", "sketch", "step", "off"] if whole else []
                    yield pa.RecordBatch.from_arrays(
                        [*names, *(rows.column(name) for name in rest)], ["dim", "tab", "cell", *rest]
                    )

    return run


def _collisions(spots: np.ndarray, tile: np.ndarray, half: float, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members of one tile (smaller place first) that collide on at least ``need`` projections.

    A projection is sorted within the tiles; a member's window reaches up to ``half`` beyond it, and what lies
    below was met from the other side. After the first LEAD projections only pairs that can still reach ``need`` are
    counted on.
    """
    size = np.bincount(tile)
    partners = np.repeat(np.cumsum(size), size) - np.arange(len(tile)) - 1
    # pair (i, i + 1) is number first[i]
    first = np.concatenate([[0], np.cumsum(partners)])
    counts = np.zeros(first[-1], np.int16)
    for column in range(LEAD):
        # projections of unit vectors lie within 1 of 0, so no window reaches the next tile
        key = 4.0 * tile + spots[:, column]
        order = np.argsort(key, kind="stable")
        key = key[order]
        reach = np.searchsorted(key, key + half, "right") - np.arange(len(key)) - 1
        one = np.repeat(np.arange(len(key)), reach)
        other = one + 1 + np.arange(len(one)) - np.repeat(np.cumsum(reach) - reach, reach)
        one, other = order[one], order[other]
        low = np.minimum(one, other)
        counts[first[low] + np.maximum(one, other) - low - 1] += 1
    rest = spots[:, LEAD:]
    pair = np.flatnonzero(counts >= need - rest.shape[1])
    count = counts[pair].astype(np.int64)
    one = np.searchsorted(first, pair, "right") - 1
    other = pair - first[one] + one + 1
    for start in range(0, len(pair), PAIRS // 16):
        part = slice(start, start + PAIRS // 16)
        count[part] += (np.abs(rest[one[part]] - rest[other[part]]) <= half).sum(axis=1)
    return one[count >= need], other[count >= need]


def _linked(plan: Plan, table: int, tile: np.ndarray, side: np.ndarray, rows: dict[str, np.ndarray], cosine: float) -> list:
    """Found rows of some whole tiles: links of each member, a forest of them, and pairs too close to call."""
    sketch, step, ids = rows["sketch"], rows["step"], rows["id"]
    spots = sketch * step[:, None]
    one, other = _collisions(spots, tile, plan.half, plan.need)
    # a tile of two shards has the pairs between them; side -1 is a shard by itself
    fresh = ((side[one] < 0) | (side[one] != side[other])) & (ids[one] != ids[other])
    one, other = one[fresh], other[fresh]
    paired, place = np.unique(np.concatenate([one, other]), return_inverse=True)
    fresh = np.ones(len(one), bool)
    for before in range(table):
        # a pair counts in the first table that brings it together
        cells = _cells(sketch[paired], plan.turns, before)[place]
        fresh &= cells[: len(one)] != cells[len(one) :]
    one, other = one[fresh], other[fresh]
    away = np.empty(len(one))
    for start in range(0, len(one), PAIRS // 16):
        part = slice(start, start + PAIRS // 16)
        away[part] = np.sqrt(((spots[one[part]] - spots[other[part]]) ** 2).sum(axis=1))
    off = rows["off"][one] + rows["off"][other]
    # distance at the wanted cosine, in all blocks together; the margin is above what rounding can do
    limit = math.sqrt(2 * (1 - cosine) * plan.blocks)
    sure = away + off < limit - 1e-9
    unsure = ~sure & (away - off <= limit + 1e-9)
    found = [(ids[one[unsure]], ids[other[unsure]], np.full(unsure.sum(), CHECK))]
    one, other = one[sure], other[sure]
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, one, rows["copies"][other])
    np.add.at(links, other, rows["copies"][one])
    have = np.flatnonzero(links)
    found.append((ids[have], ids[have], links[have]))
    label = np.arange(len(ids))
    while len(one):
        before = label.copy()
        least = np.minimum(label[one], label[other])
        np.minimum.at(label, one, least)
        np.minimum.at(label, other, least)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(ids)))
    found.append((ids[moved], ids[label[moved]], np.full(len(moved), EDGE)))
    return found


def _count(plans: dict[int, Plan], cosine: float):
    """Reads rows sorted by dimension, table and tile, and counts whole tiles together."""

    def runs(table: pa.Table) -> np.ndarray:
        """First row of each tile, and the end."""
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for name in ("dim", "tab", "cell", "one", "other"):
            values = np.asarray(table.column(name))
            new[1:] |= values[1:] != values[:-1]
        return np.append(np.flatnonzero(new), table.num_rows)

    def counted(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        members = np.diff(starts)
        kind = np.asarray(table.column("dim"))[starts[:-1]] * 100_000 + np.asarray(table.column("tab"))[starts[:-1]]
        work = np.cumsum(members * (members - 1) // 2)
        at = 0
        while at < len(members):
            done = work[at - 1] if at else 0
            end = max(int(np.searchsorted(work, done + PAIRS, "right")), at + 1)
            end = min(end, at + int(np.argmax(np.append(kind[at:] != kind[at], True))))
            here = table.slice(starts[at], starts[end] - starts[at])
            dim, tab = here.column("dim")[0].as_py(), here.column("tab")[0].as_py()
            tile = np.repeat(np.arange(end - at), members[at:end])
            rows = {name: np.asarray(here.column(name)) for name in ("id", "copies", "step", "off")}
            rows["sketch"] = _signs(here.column("sketch"))
            for a, b, n in _linked(plans[dim], tab, tile, np.asarray(here.column("side")), rows, cosine):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n.astype(np.int64))], ["a", "b", "n"])
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
            if not table.num_rows:
                continue
            starts = runs(table)
            # the last tile may go on in the next batch
            yield from counted(table, starts[:-1])
            rest = table.slice(starts[-2])
        if rest is not None:
            yield from counted(rest, runs(rest))

    return run


def _verify(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose cosine in double precision is high enough."""
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for (_, at, left), (_, _, right) in zip(_usable(batch.column(2)), _usable(batch.column(3)), strict=True):
                keep[at] = (left * right).sum(axis=1) >= cosine
            yield batch.select([0, 1]).filter(pa.array(keep))

    return run


def _tiles(dealt: DataFrame, hot: DataFrame) -> DataFrame:
    """Each row once for every tile that its shard is part of; cells of one shard are one tile."""
    placed = dealt.join(hot, ["dim", "tab", "cell"], "left").withColumn(
        "shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int")
    )
    mates = F.when(F.col("shards").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("shards") - 1))
    shard = F.coalesce("shard", F.lit(0))
    return placed.withColumn("mate", F.explode(mates)).select(
        *dealt.columns,
        F.least(shard, "mate").alias("one"),
        F.greatest(shard, "mate").alias("other"),
        F.when(shard == F.col("mate"), -1).otherwise((shard > F.col("mate")).cast("int")).alias("side"),
    )


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding)``.

    Two vectors link when they are found by their collisions and their cosine, in double precision, is at least
    ``cosine``. Equal vectors are one, so copies never form pairs. ``n_links`` has the other rows linked directly,
    ``component_id`` is the smallest vec_id reachable, ``kept`` marks the row that has it.

    The pairs of a tile are counted where they meet: what leaves a task is a number of links per vector, a forest of
    the linked ones, and only those pairs whose rounded projections leave open on which side of ``cosine`` they are.
    A pair counts in the first table that deals it to one cell. A cell of many vectors is dealt in tiles.

    A vector that is NULL, empty, zero or has a NULL or non-finite component links with nothing and is kept, as does a
    row without vec_id, whose component is NULL. Vectors of different lengths never link. Rows repeating a
    vec_id with its vector count as copies; different vectors of one vec_id do not link with each other and share
    their links. Other columns are ignored.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>"))
    rows = stage(vectors.mapInArrow(_read, SKETCHED), "sketches")
    usable = rows.where("key is not null")
    given = F.struct("vec_id", "sketch", "step", "off", "dim")
    texts = usable.groupBy("key").agg(F.min(given).alias("first"), F.count(F.lit(1)).alias("copies"))
    nodes = stage(texts.select("key", F.col("first.vec_id").alias("id"), "copies", "first.dim", "first.sketch", "first.step", "first.off"), "vectors")
    # one row for each length of vector
    plans = {row.dim: make_plan(row.dim, row.n, cosine) for row in nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    source = nodes.select("dim", "id", "copies", "sketch", "step", "off")
    cells = source.mapInArrow(_deal(plans, False), CELL).groupBy("dim", "tab", "cell").agg(F.count(F.lit(1)).alias("members"))
    hot = cells.where(F.col("members") > SHARD)
    hot = stage(hot.select("dim", "tab", "cell", F.ceil(F.col("members") / SHARD).cast("int").alias("shards")), "hot-cells")
    tiles = _tiles(source.mapInArrow(_deal(plans, True), DEALT), hot)
    order = ["dim", "tab", "cell", "one", "other"]
    dealt = tiles.repartition(*order).sortWithinPartitions(*order)
    found = stage(dealt.mapInArrow(_count(plans, cosine), FOUND), "collisions")
    checks = found.where(F.col("n") == CHECK).select("a", "b")
    ends = checks.select(F.col("a").alias("vec_id")).union(checks.select("b")).distinct()
    named = stage(vectors.join(ends, "vec_id").dropDuplicates(["vec_id"]), "checked-vectors")
    left = named.select(F.col("vec_id").alias("a"), F.col("embedding").alias("left"))
    right = named.select(F.col("vec_id").alias("b"), F.col("embedding").alias("right"))
    links = checks.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    links = stage(links.mapInArrow(_verify(cosine), "a long, b long"), "checked-links")
    copies = nodes.groupBy("id").agg(F.sum("copies").alias("copies"))
    both = links.select("a", "b").union(links.select("b", "a"))
    counts = both.join(copies.withColumnRenamed("id", "b"), "b").select("a", F.col("copies").alias("n"))
    counts = counts.union(found.where("n > 0").select("a", "n")).groupBy("a").agg(F.sum("n").alias("n"))
    scratch = Scratch(spark)
    edges = found.where(F.col("n") == EDGE).select("a", "b").union(links).distinct()
    groups = components(edges, scratch)
    result = (
        nodes.select("key", "id", "copies")
        .join(counts.withColumnRenamed("a", "id"), "id", "left")
        .join(groups, "id", "left")
        .select(
            "key",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    result = stage(result, "vector-groups")
    scratch.clear()
    done = rows.select("vec_id", "key").join(result, "key", "left")
    own = F.coalesce("component_id", "vec_id")
    return done.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
