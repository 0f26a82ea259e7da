"""Approximate nearest neighbours: multiprobe p-stable hashing with exact reranking.

Unit vectors are hashed by floor((a.v + b) / w) with Gaussian a, several of these to a table. A query
visits, in each table, its own bucket and then perturbed ones in the order of their estimated success: the
squared distance to the bucket borders that a perturbation crosses. Candidates of all tables are ranked by
their exact cosine inside their bucket, and only the best of each bucket travel on to be merged.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenrec.llm.words import mix64, signed
from goldenrec.session import stage

NEAREST = 5
TABLES = 10
PROBES = 24
WIDTH = 2.0
SEED = 20
# Rows of an index shard and queries of a query shard; larger buckets are split into more of them.
SHARD = 8192
# Share of the true neighbours of SAMPLE queries that the probes have to meet; for it up to MOST_PROBES are made, and
# then fewer functions hash a table.
RECALL = 0.96
SAMPLE = 128
MOST_PROBES = 96
# Queries searched exactly at once when the buckets gave them too few.
EXACT_BLOCK = 2048

_U = np.uint64
INDEX = "tab int, bucket long, ids array<long>, vector binary"
PROBE = "tab int, bucket long, query_id long, vector binary"
NOTHING = pa.table(
    {"query_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())), "score": pa.array([], pa.float64())}
)
FOUND = "query_id long, ids array<long>, score double"


def functions_per_table(vectors: int) -> int:
    """Half the binary logarithm of the number of vectors, so buckets grow as its square root at most."""
    return max(2, int(math.log2(max(vectors, 2)) / 2))


def perturbations(size: int, count: int) -> list[tuple[int, ...]]:
    """Sets of border ranks, by ascending expected sum of squared distances.

    Rank j is the j-th nearest of the 2 * size borders around a point; ranks j and 2 * size - 1 - j are
    the two sides of one function and never crossed together.
    """
    low = np.arange(1, size + 1)
    near = low * (low + 1) / (4 * (size + 1) * (size + 2))
    back = np.arange(size, 0, -1)
    far = 1 - back / (size + 1) + back * (back + 1) / (4 * (size + 1) * (size + 2))
    cost = np.concatenate([near, far])
    found: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(found) < count:
        total, ranks = heapq.heappop(heap)
        if len({min(r, 2 * size - 1 - r) for r in ranks}) == len(ranks):
            found.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * size:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], ranks[:-1] + (last + 1,)))
            heapq.heappush(heap, (total + cost[last + 1], ranks + (last + 1,)))
    return found


class _Hash:
    """The hash functions of all tables, the same in every task."""

    def __init__(self, dimensions: int, size: int) -> None:
        random = np.random.default_rng(SEED)
        self.size = size
        self.lines = random.standard_normal((TABLES, dimensions, size)) / WIDTH
        self.shifts = random.random((TABLES, size))

    def places(self, unit: np.ndarray, tab: int) -> tuple[np.ndarray, np.ndarray]:
        spot = unit @ self.lines[tab] + self.shifts[tab]
        cell = np.floor(spot).astype(np.int64)
        return cell, spot - cell

    def bucket(self, cells: np.ndarray) -> np.ndarray:
        total = np.zeros(len(cells), _U)
        for column in range(self.size):
            total = mix64(total * _U(31) + cells[:, column].astype(_U))
        return signed(total)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of a column of equally long lists."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _units(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that squares of huge or tiny components stay finite
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _packed(vectors: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in vectors]


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def _index(dimensions: int, size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hash(dimensions, size)
        for batch in batches:
            vectors = _matrix(batch.column(1))
            if not len(vectors):
                continue
            unit, packed = _units(vectors), pa.array(_packed(vectors), pa.binary())
            for tab in range(TABLES):
                cells, _ = hashes.places(unit, tab)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(vectors), tab, np.int32)), pa.array(hashes.bucket(cells)), batch.column(0), packed],
                    ["tab", "bucket", "ids", "vector"],
                )

    return run


def _moved(cells: np.ndarray, rank: np.ndarray, ranks: tuple[int, ...]) -> np.ndarray:
    """The cells beyond the borders of the given ranks."""
    moved, rows, size = cells.copy(), np.arange(len(cells)), cells.shape[1]
    for place in ranks:
        border = rank[:, place]
        moved[rows, border % size] += np.where(border < size, -1, 1)
    return moved


def _border_ranks(inside: np.ndarray) -> np.ndarray:
    return np.argsort(np.concatenate([inside, 1 - inside], axis=1), axis=1, kind="stable")


def _settings(left: np.ndarray, right: np.ndarray, size: int) -> tuple[int, int]:
    """Functions a table and probes at which queries ``left`` meet RECALL of their true neighbours ``right``."""
    if not len(left):
        return size, PROBES
    left, right = _units(left), _units(right)
    for functions in range(size, 0, -1):
        hashes, order = _Hash(left.shape[1], functions), perturbations(functions, max(PROBES, MOST_PROBES))
        met = np.full(len(left), len(order))
        for tab in range(TABLES):
            cells, inside = hashes.places(left, tab)
            wanted, rank = hashes.places(right, tab)[0], _border_ranks(inside)
            for turn, ranks in enumerate(order):
                met[(_moved(cells, rank, ranks) == wanted).all(axis=1) & (met > turn)] = turn
        probes = int(np.sort(met)[math.ceil(RECALL * len(met)) - 1]) + 1
        if probes <= len(order):
            return functions, max(PROBES, probes)
    return 1, PROBES


def _probe(dimensions: int, size: int, probes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, order = _Hash(dimensions, size), perturbations(size, probes)
        for batch in batches:
            vectors = _matrix(batch.column(1))
            if not len(vectors):
                continue
            unit, packed = _units(vectors), pa.array(_packed(vectors), pa.binary())
            rows = np.arange(len(vectors))
            for tab in range(TABLES):
                cells, inside = hashes.places(unit, tab)
                rank = _border_ranks(inside)
                for ranks in order:
                    moved = _moved(cells, rank, ranks)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), tab, np.int32)), pa.array(hashes.bucket(moved)), batch.column(0), packed],
                        ["tab", "bucket", "query_id", "vector"],
                    )

    return run


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: list[list[int]], vectors: np.ndarray) -> pa.Table:
    """The six nearest vectors of each query: one of them may be the query itself."""
    first = np.array([own[0] for own in ids], np.int64)
    order = np.argsort(first, kind="stable")
    vectors, unit = vectors[order], _units(vectors)[order]
    keep = min(NEAREST + 1, len(vectors))
    rows, columns = [], []
    for begin in range(0, len(queries), 512):
        scores = _units(queries[begin : begin + 512]) @ unit.T
        # stable: equal scores stay in the order of the ids
        best = np.argsort(-np.round(scores, 12), axis=1, kind="stable")[:, :keep]
        rows.append(np.repeat(np.arange(begin, begin + len(best)), keep))
        columns.append(best.reshape(-1))
    row, column = np.concatenate(rows), np.concatenate(columns)
    return pa.table(
        {
            "query_id": pa.array(query_ids[row]),
            "ids": pa.array([ids[order[place]] for place in column], pa.list_(pa.int64())),
            "score": pa.array(_cosine(queries[row], vectors[column])),
        }
    )


def _cosine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pair by pair, so that a pair's score does not depend on what else is in the bucket."""
    left, right = (x / np.abs(x).max(axis=1, keepdims=True) for x in (left, right))
    return (left * right).sum(axis=1) / (np.sqrt((left**2).sum(axis=1)) * np.sqrt((right**2).sum(axis=1)))


def _rank_bucket(queries: pa.Table, index: pa.Table) -> pa.Table:
    if not queries.num_rows or not index.num_rows:
        return NOTHING
    ids = np.asarray(queries.column("query_id"))
    return _best(ids, _unpacked(queries.column("vector")), index.column("ids").to_pylist(), _unpacked(index.column("vector")))


def _rank_all(shared) -> Callable:
    """Task function: the block's queries against every vector of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        for batch in batches:
            vectors = _matrix(batch.column(1))
            if len(vectors):
                yield from _best(query_ids, queries, batch.column(0).to_pylist(), vectors).to_batches()

    return run


def _ranked(found: DataFrame) -> DataFrame:
    """Five best of what was found for each query, ties to the smaller id."""
    rows = found.select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
    # a pair met in several tables has one score
    rows = rows.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEAREST)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _true_pairs(known: DataFrame, entries: DataFrame, asked: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of SAMPLE queries and of their exact neighbours, pair by pair."""
    rows = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    if not rows:
        return np.zeros((0, 1)), np.zeros((0, 1))
    value = (np.array([r.vec_id for r in rows], np.int64), np.array([r.embedding for r in rows], np.float64))
    shared = known.sparkSession.sparkContext.broadcast(value)
    nearest_ = _ranked(entries.mapInArrow(_rank_all(shared), FOUND)).select("query_id", "vec_id")
    pairs = known.join(F.broadcast(nearest_), "vec_id").select("query_id", "embedding").collect()
    place = {query_id: i for i, query_id in enumerate(value[0].tolist())}
    left = value[1][np.array([place[r.query_id] for r in pairs], np.int64)]
    return left, np.array([r.embedding for r in pairs], np.float64).reshape(left.shape)


def usable(vector: Column) -> Column:
    """Not NULL, not zero, no NULL or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: Column) -> DataFrame:
    """``query_id, rank, vec_id, score``: the 5 nearest found for the rows of ``vectors`` where ``queries`` holds.

    ``vectors(vec_id, embedding)``; nearness is the cosine in double precision, ties go to the smaller
    vec_id, a query is no candidate of its own. Equal vectors are one entry with its smallest ids, so copies
    do not crowd a bucket. Functions and probes are chosen so that a sample of queries, searched exactly, meets RECALL
    of its neighbours. Buckets beyond SHARD rows or queries are split over several tasks. Queries that
    the buckets give fewer than 5 candidates are searched exactly, in blocks.

    NULL, zero and ragged vectors (not as long as the longest) and those with NULL or non-finite
    components take no part, nor does a NULL vec_id. Of rows repeating a vec_id the smallest vector counts.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    known = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    known = known.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("embedding"))
    known = stage(known, "vectors")
    dimensions = known.agg(F.max(F.size("embedding")).alias("n")).first().n or 0
    known = known.where(F.size("embedding") == dimensions)
    # the five smallest others of equal vectors are all that can be reported
    order = Window.partitionBy("embedding").orderBy("vec_id")
    least = known.withColumn("place", F.row_number().over(order)).where(F.col("place") <= NEAREST + 1)
    entries = least.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    entries = stage(entries.select("ids", "embedding"), "distinct-vectors")
    asked = known.where(queries).select("vec_id", "embedding")
    size, probes = _settings(*_true_pairs(known, entries, asked), functions_per_table(entries.count()))
    index = entries.mapInArrow(_index(dimensions, size), INDEX)
    probes = asked.mapInArrow(_probe(dimensions, size, probes), PROBE)
    keys = ["tab", "bucket"]
    shards = (
        index.groupBy(*keys)
        .agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("shards"))
        .join(probes.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("turns")), keys)
    )
    shards = stage(shards, "buckets")

    def own(count: str, seed: str) -> Column:
        return F.pmod(F.xxhash64(seed), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = probes.join(shards, keys).withColumn("turn", own("turns", "query_id")).withColumn("shard", every("shards"))
    right = index.join(shards, keys).withColumn("shard", own("shards", "vector")).withColumn("turn", every("turns"))
    keys = [*keys, "shard", "turn"]
    left, right = left.select(*keys, "query_id", "vector"), right.select(*keys, "ids", "vector")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_rank_bucket, FOUND)
    found = stage(_ranked(found), "neighbours")
    wanted = min(NEAREST, known.count() - 1)
    counts = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= wanted)
    short = asked.withColumnRenamed("vec_id", "query_id").join(counts, "query_id", "left_anti")
    short = stage(short, "short-queries")
    blocks = -(-short.count() // EXACT_BLOCK) if wanted > 0 else 0
    result = found.join(short, "query_id", "left_anti") if blocks else found
    for block in range(blocks):
        rows = short.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).collect()
        if rows:
            value = (np.array([r.query_id for r in rows], np.int64), np.array([r.embedding for r in rows], np.float64))
            shared = spark.sparkContext.broadcast(value)
            result = result.unionByName(_ranked(entries.mapInArrow(_rank_all(shared), FOUND)))
    return result
