"""The mix against its definition, worked out step by step in Python."""

import hashlib
import re
from collections import defaultdict
from fractions import Fraction

from goldenrec.llm.mixing import BLOCK_WORDS, BLOCKS_LEAST, GOLDEN, PASSES, POINT_BITS, mix
from tests.llm.conftest import prose

SCHEMA = "doc_id long, source string, text string, taken string, size string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(totals):
    """Sharing by weight, then resharing what the capped ones leave, until none is above."""
    names = sorted((n for n in totals if n is not None)) + ([None] if None in totals else [])
    weight = {n: (1, 2, 3)[i % 3] for i, n in enumerate(names)}
    found, free, rest = {}, set(names), Fraction(sum(totals.values()))
    while free:
        whole = sum(weight[n] for n in free)
        above = {n for n in free if rest * weight[n] / whole > PASSES * totals[n]}
        if not above:
            return found | {n: rest * weight[n] / whole for n in free}
        for n in above:
            found[n] = Fraction(PASSES * totals[n])
        rest -= sum(found[n] for n in above)
        free -= above
    return found


def rows_of():
    rows = [(i, "big", prose(i, 40 + i % 50)) for i in range(150)]
    rows += [(1000 + i, "small", prose(i, 5)) for i in range(4)]
    rows += [(2000 + i, None, prose(i, 60)) for i in range(20)]
    rows += [(3000, "tiny", "one"), (3001, "void", None), (3002, "void", " \t"), (None, "big", "no id here")]
    rows += [(7, "other", prose(1, 3000)), (8, "other", "twice the same"), (8, "other", "twice the same")]
    return rows


def test_against_the_definition(spark):
    rows = rows_of()
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    found = mix(frame).collect()
    assert sorted((str(r.doc_id), str(r.source), r.size) for r in found) == sorted(
        (str(d), str(s), len(WORD.findall(t or ""))) for d, s, t in rows
    )
    totals, taken = defaultdict(int), defaultdict(int)
    for r in found:
        totals[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= PASSES * r.size
    wanted = targets(totals)
    for r in found:
        assert r.source_size == totals[r.source]
        assert abs(r.target - float(wanted[r.source])) < 1e-6
    for source, size in totals.items():
        block = max(min(size // BLOCKS_LEAST, BLOCK_WORDS), 1)
        assert abs(taken[source] - wanted[source]) <= 6 * block, source
    again = mix(frame.repartition(2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_no_python_runs(spark):
    frame = spark.createDataFrame([(1, "a", "x y", "", "")], SCHEMA)
    plan = mix(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_and_wordless(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    (row,) = mix(spark.createDataFrame([(1, None, None, "", "")], SCHEMA)).collect()
    assert (row.size, row.source_size, row.target, row.taken) == (0, 0, 0.0, 0)


def test_points_are_spread_evenly():
    points = sorted(i * GOLDEN % (1 << POINT_BITS) for i in range(1000))
    gaps = [b - a for a, b in zip(points, points[1:], strict=False)]
    assert len(set(points)) == 1000 and max(gaps) < 3 * (1 << POINT_BITS) / 1000
    assert hashlib.md5(b"7").hexdigest()[:3] == "8f1"
