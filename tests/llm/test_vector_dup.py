"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from goldenrec.llm import vector_dup
from goldenrec.llm.vector_dup import _collisions, make_plan, near_vectors

SCHEMA = "vec_id long, embedding array<double>, key string, N_Links int"


def near(rng, centre, cosine):
    """A vector at this cosine from the centre."""
    aside = rng.standard_normal(len(centre))
    aside -= aside @ centre * centre
    return cosine * centre + np.sqrt(1 - cosine**2) * aside / np.linalg.norm(aside)


def brute(rows, cosine=0.9):
    """(vec_id, n_links, component) by all pairs."""
    usable = [i for i, (v, e) in enumerate(rows) if v is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    units = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in usable}
    label, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in usable:
        for b in usable:
            if a < b and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine:
                links[a] += 1
                links[b] += 1
                label[find(a)] = find(b)
    least = {}
    for i in usable:
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted((v, n, least[find(i)] if i in units else v) for i, ((v, _), n) in enumerate(zip(rows, links)))


def check(spark, rows):
    frame = spark.createDataFrame([(v, e, "k", 1) for v, e in rows], SCHEMA).repartition(3)
    got = near_vectors(frame).collect()
    assert all(r.kept == (r.vec_id == r.component_id or r.vec_id is None) for r in got)
    order = lambda row: tuple((x is None, x) for x in row)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=order)


@pytest.fixture(scope="module")
def clusters():
    rng = np.random.default_rng(1)
    vectors = list(rng.standard_normal((300, 48)))
    unit = vectors[0] / np.linalg.norm(vectors[0])
    vectors += [near(rng, unit, c) * 3 for c in rng.uniform(0.985, 0.999, 120)]
    vectors += [near(rng, vectors[i] / np.linalg.norm(vectors[i]), 0.97) for i in range(10, 40)]
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(vectors)) * 3, vectors)]
    # many exact copies, and copies of another length
    return rows + [(5000 + i, rows[50][1]) for i in range(200)] + [(6000, [2 * x for x in rows[50][1]])]


def test_against_all_pairs(spark, clusters):
    assert check(spark, clusters) == brute(clusters)


def test_cells_in_tiles(spark, clusters, monkeypatch):
    monkeypatch.setattr(vector_dup, "SHARD", 7)
    monkeypatch.setattr(vector_dup, "PAIRS", 64)
    assert check(spark, clusters) == brute(clusters)


def test_recall_at_the_border_and_no_false_links(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((1500, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    cosines = rng.uniform(0.88, 0.93, 1500)
    rows = [(2 * i, v.tolist()) for i, v in enumerate(base)]
    rows += [(2 * i + 1, near(rng, v, c).tolist()) for i, (v, c) in enumerate(zip(base, cosines))]
    wanted = {row[0]: row[1] for row in brute_fast(rows)}
    got = {v: n for v, n, _ in check(spark, rows)}
    assert all(got[v] <= wanted[v] for v in wanted)
    assert sum(got.values()) >= 0.95 * sum(wanted.values())


def brute_fast(rows):
    vectors = np.array([e for _, e in rows])
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    return [(v, int((vectors @ u >= 0.9).sum()) - 1) for (v, _), u in zip(rows, vectors)]


def test_pairs_too_close_to_call_are_verified(spark):
    rng = np.random.default_rng(3)
    unit = rng.standard_normal(64)
    unit /= np.linalg.norm(unit)
    rows = [(0, unit.tolist())]
    for i, c in enumerate([0.9 - 1e-6, 0.9 + 1e-6, 0.9 - 1e-4, 0.9 + 1e-4, 0.903, 0.897] * 5, 1):
        rows.append((i, near(rng, unit, c).tolist()))
    got = {v: n for v, n, _ in check(spark, rows)}
    wanted = {v: n for v, n, _ in brute(rows)}
    assert all(got[v] <= wanted[v] for v in wanted) and got[0] >= 13


def test_unusable_and_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0])]
    rows += [(7, [1.0, 0.0]), (8, [1e200, 1e180]), (9, [1e-200, 0.0]), (10, [1.0]), (11, [2.0]), (12, [-1.0]), (13, [-0.0, 5.0])]
    rows += [(14, [0.0, 5.0]), (7, [1.0, 0.0])]
    got = check(spark, [*rows, (None, [1.0, 0.0])])
    assert got[-1] == (None, 0, None)
    assert [r[1:] for r in got[:6]] == [(0, v) for v in range(1, 7)]
    assert got[6:-1] == [(7, 3, 7), (7, 3, 7), (8, 3, 7), (9, 3, 7), (10, 1, 10), (11, 1, 10), (12, 0, 12), (13, 1, 13), (14, 1, 13)]


def test_empty(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert near_vectors(spark.createDataFrame([(1, None, "", 2)], SCHEMA)).count() == 1


def test_window_counts_are_exact():
    rng = np.random.default_rng(4)
    tile = np.repeat([0, 1, 2, 3], [1, 30, 2, 60])
    spots = rng.uniform(-1, 1, (len(tile), 40)) * 0.5
    one, other = _collisions(spots, tile, 0.2, 14)
    close = (np.abs(spots[:, None] - spots[None]) <= 0.2).sum(axis=2) >= 14
    close &= tile[:, None] == tile[None]
    assert sorted(zip(one.tolist(), other.tolist())) == sorted((a, b) for a, b in zip(*np.nonzero(close)) if a < b)
    assert len(one) > 100


@pytest.mark.parametrize(("dim", "vectors"), [(64, 50_000), (64, 10**8), (3, 1000), (300, 10**6)])
def test_calibrated_recall(dim, vectors):
    assert make_plan(dim, vectors).recall >= 0.94
