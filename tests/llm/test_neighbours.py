"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from goldenrec.llm import neighbours
from goldenrec.session import stage
from goldenrec.llm.neighbours import nearest, perturbations
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, query):
    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v) or len(v) != 16:
            continue
        good[i] = min(good.get(i, v), v)
    unit = {i: np.array(v, np.float32).astype(float) for i, v in good.items()}
    unit = {i: v / np.sqrt((v * v).sum()) for i, v in unit.items()}
    out = {}
    for q in unit:
        if query(q):
            scores = sorted((-round(float(unit[q] @ v), 12), i) for i, v in unit.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:5]]
    return out


def rows_of(count):
    random = np.random.default_rng(3)
    centres = random.normal(size=(12, 16))
    data = centres[random.integers(0, 12, count)] + 0.5 * random.normal(size=(count, 16))
    rows = [(i, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate(data)]
    same = rows[7][1]
    rows += [(count + i, same) for i in range(40)] + [(7, same)]
    rows += [(9000, None), (9010, [0.0] * 16), (9020, [float("nan")] * 16), (9030, [1.0] * 15 + [None])]
    rows += [(9040, [float("inf")] + [1.0] * 15), (9050, [1.0] * 3), (None, same), (9060, [1e30] * 16), (9070, [1e-30] * 16)]
    return rows


@pytest.mark.parametrize("shard", [8192, 16])
def test_recall_and_exact_scores(spark, monkeypatch, shard):
    monkeypatch.setattr(neighbours, "SHARD", shard)
    rows = rows_of(600)
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(4)
    found = {}
    for r in nearest(frame, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    wanted = brute(rows, lambda i: i % 10 == 0)
    assert set(found) == set(wanted)
    hits = 0
    for q, own in found.items():
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        exact = dict(wanted[q])
        for _, i, score in own:
            if i in exact:
                hits += 1
                assert abs(score - exact[i]) < 1e-9
    assert hits >= 0.9 * 5 * len(wanted)
    # of equal vectors the smallest ids
    assert [i for _, i, _ in found[600]] == [7, 601, 602, 603, 604]


def test_recall_holds_without_clusters_and_in_many_dimensions(spark):
    frame = spark.range(0, 20_000, 1, 8).select(
        F.col("id").alias("vec_id"), F.array(*[F.randn(i).cast("float") for i in range(128)]).alias("embedding")
    )
    frame = stage(frame, "many-vectors")
    found = {}
    for r in nearest(frame, F.col("vec_id") % 200 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    rows = frame.collect()
    ids, unit = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
    hits = 0
    for at in np.flatnonzero(ids % 200 == 0):
        best = ids[np.argsort(-(unit @ unit[at]), kind="stable")[:6]]
        hits += len(found[ids[at]] & set(best.tolist()))
    assert len(found) == 100 and hits >= 0.9 * 500, hits


def test_few_candidates_are_searched_exactly(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TABLES", 1)
    monkeypatch.setattr(neighbours, "PROBES", 1)
    monkeypatch.setattr(neighbours, "functions_per_table", lambda n: 12)
    rows = rows_of(200)
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    found = nearest(frame, F.col("vec_id") % 10 == 0)
    counts = {r.query_id: r["count"] for r in found.groupBy("query_id").count().collect()}
    assert counts == {q: 5 for q in brute(rows, lambda i: i % 10 == 0)}


def test_small_and_empty(spark):
    frame = spark.createDataFrame([(i, [1.0, float(i)], 1, "x") for i in range(3)], SCHEMA)
    found = nearest(frame, F.lit(True)).collect()
    assert sorted((r.query_id, r["rank"]) for r in found) == [(q, k) for q in range(3) for k in (1, 2)]
    assert nearest(frame.limit(0), F.lit(True)).count() == 0
    assert nearest(frame.limit(1), F.lit(True)).count() == 0


def test_probes_come_in_the_order_of_their_cost():
    sets = perturbations(5, 40)
    assert sets[0] == () and sets[1] == (0,) and len(set(sets)) == 40
    assert all(len({min(r, 9 - r) for r in ranks}) == len(ranks) for ranks in sets)
