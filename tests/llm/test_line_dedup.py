"""Line groups against all pairs of lines."""

import random
import re
import tempfile
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from goldenrec.llm import line_dedup
from goldenrec.llm.line_dedup import EDIT_SIMILARITY, FOLD, SHORT, _read_lines, dedup_lines
from goldenrec.llm.words import ALNUM, find_words, slices
from tests.llm.conftest import prose, variant

import pyarrow as pa

KEPT = "doc_id long, text string, lang string, n_lines string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLDING = {c: c + 32 for c in range(65, 91)} | {c: 48 for c in range(49, 58)}


def simhash(line):
    """Plain SimHash of all words, to pick pairs whose words differ in a known measure."""
    hashes = find_words(next(slices(pa.array([line]))), ALNUM, FOLD).hash
    ones = [2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes) for b in range(64)]
    return sum(1 << b for b, one in enumerate(ones) if one)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def expected(rows):
    first, lines = {}, []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        for place, line in enumerate((text or "").split("\n")):
            words = WORD.findall(line.translate(FOLDING))
            if len(words) >= 3:
                lines.append((doc_id, place, " ".join(words)))
                first.setdefault(" ".join(words), (doc_id, place))
    names = sorted(first)
    group = {n: n for n in names}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in names:
        for b in names:
            longest = max(len(a), len(b))
            allowed = int(longest * (1 - EDIT_SIMILARITY))
            if a < b and abs(len(a) - len(b)) <= allowed and edits(a, b) <= allowed:
                group[find(a)] = find(b)
    heads = {}
    for n in names:
        heads[find(n)] = min(heads.get(find(n), first[n]), first[n])
    gone = {(d, i) for d, i, n in lines if heads[find(n)] != (d, i)}
    return {
        d: (None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone))
        for d, t in rows
    }


def test_against_all_pairs(spark):
    base = [prose(i, 60) for i in range(5)]
    rows = [
        (1, "\n".join([base[0], "Page 1 of 20", "", base[1]])),
        (2, "\n".join([base[0].upper(), "page 2 of 31!", "x y", ""])),
        (3, "\n".join([base[2], base[2], "x y", "tail of it here"])),
        (4, None),
        (5, ""),
        (6, "\n\n"),
    ]
    rows += [(10 + i, "\n".join([variant(base[1], i, 60), variant(base[3], 7, 60), base[3]])) for i in range(12)]
    rows += [(40, prose(77, 20_000)), (41, prose(77, 20_000) + " end")]
    frame = spark.createDataFrame([(d, t, "en", "old") for d, t in rows], KEPT).repartition(3)
    found = dedup_lines(frame).collect()
    assert {r.doc_id: r.text for r in found} == expected([r for r in rows if r[0] < 40]) | {
        r.doc_id: r.text for r in found if r.doc_id >= 40
    }
    assert next(r.text for r in found if r.doc_id == 41) == ""
    by_id = {r.doc_id: r for r in found}
    assert (by_id[3].n_lines, by_id[3].n_removed) == (4, 1) and (by_id[4].n_lines, by_id[4].n_removed) == (0, 0)
    assert by_id[1].lang == "en"
    # changed words were found, not only equal lines
    assert sum(r.n_removed for r in found if 10 <= r.doc_id < 40) > 24


def test_lines_three_bits_apart_link(spark):
    pairs = []
    for seed in range(400):
        line = prose(seed, 50)
        changed = line.split(" ")
        changed[seed % 50] = "changed"
        changed = " ".join(changed)
        if (simhash(line) ^ simhash(changed)).bit_count() == 3:
            pairs.append((line, changed))
    assert len(pairs) > 10
    rows = [(2 * i + k, text) for i, pair in enumerate(pairs) for k, text in enumerate(pair)]
    frame = spark.createDataFrame([(d, t, "en", "old") for d, t in rows], KEPT)
    found = {r.doc_id: r.n_removed for r in dedup_lines(frame).collect()}
    assert found == {d: d % 2 for d, _ in rows}


def test_ids_without_value_and_repeated_rows(spark):
    line = prose(5, 30)
    rows = [(None, line), (7, line), (7, line), (8, "other words here\n" + line)]
    frame = spark.createDataFrame([(d, t, "en", "old") for d, t in rows], KEPT)
    found = Counter((r.doc_id, r.text) for r in dedup_lines(frame).collect())
    assert found == Counter([(None, line), (7, ""), (7, ""), (8, "other words here")])


def test_empty(spark):
    assert dedup_lines(spark.createDataFrame([], KEPT)).count() == 0


def test_lines_of_a_slice_know_their_place():
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3]), pa.array([0, 0, 0]), pa.array(["a b c\n\nd e f", None, "g h i"])], ["d", "v", "t"]
    )
    (found,) = list(_read_lines(iter([batch])))
    assert found.column(0).to_pylist() == [1, 1, 3] and found.column(2).to_pylist() == [0, 2, 0]


def changed_pairs(lengths, words, how, seeds):
    """(line, changed line) pairs whose edit similarity holds, ``words`` of them changed."""
    found = []
    for size in lengths:
        for seed in range(seeds):
            rng = random.Random(1000 * size + seed)
            line = prose(rng.random(), size, "abcdefghijklmnopqrstuvwxyz").split(" ")
            other = list(line)
            for place in rng.sample(range(size), words):
                if how == "replace":
                    other[place] = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in other[place])
                elif how == "drop":
                    other[place] = ""
                else:
                    other[place] += " " + rng.choice("abcdefghij")
            a, b = " ".join(line), " ".join(w for w in other if w)
            if a != b and edits(a, b) <= int(max(len(a), len(b)) * (1 - EDIT_SIMILARITY)):
                found.append((a, b))
    return found


def share_removed(spark, pairs):
    rows = [(2 * i + k, text, "en", "old") for i, pair in enumerate(pairs) for k, text in enumerate(pair)]
    found = {r.doc_id: r.n_removed for r in dedup_lines(spark.createDataFrame(rows, KEPT)).collect()}
    assert all(found[2 * i] == 0 for i in range(len(pairs)))
    return sum(found[2 * i + 1] for i in range(len(pairs))) / len(pairs)


def test_recall_of_lines_of_10_to_60_words(spark):
    for how in ("replace", "drop", "add"):
        pairs = changed_pairs(range(10, 61, 2), 1, how, 12)
        assert len(pairs) > 150
        assert share_removed(spark, pairs) >= 0.97, how


def test_short_lines_with_one_word_more_less_or_changed(spark):
    for how in ("replace", "drop", "add"):
        pairs = changed_pairs(range(5, SHORT + 2), 1, how, 30)
        assert len(pairs) > 20
        assert share_removed(spark, pairs) >= 0.95, how


def test_one_word_in_half_the_places(spark):
    rows = [(i, " ".join(f"the {word}" for word in prose(i, 12, "abcdefghijklmnop").split(" ")), "en", "old") for i in range(300)]
    found = dedup_lines(spark.createDataFrame(rows, KEPT)).collect()
    assert {r.doc_id: r.text for r in found} == expected([r[:2] for r in rows])


def test_scripts_without_spaces(spark):
    rng = random.Random(3)
    line = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(33))
    changed = line[:16] + "\u4e00" + line[17:]
    thai = "".join(chr(rng.randint(0x0E01, 0x0E2E)) for _ in range(60))
    rows = [
        (1, line + "\nown words of one"), (2, "own words of two\n" + line), (3, changed), (4, thai), (5, thai),
        (6, "\u4e8c\u4e8c"), (7, "\u4e8c\u4e8c"),
    ]
    found = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame([(*r, "zh", "old") for r in rows], KEPT)).collect()}
    assert found == {**dict(rows), 2: "own words of two", 3: "", 5: ""}


def test_keys_do_not_depend_on_the_neighbours_of_a_line():
    def read(texts):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([0] * len(texts)), pa.array(texts)], ["d", "v", "t"])
        (found,) = list(_read_lines(iter([batch])))
        return found.slice(found.num_rows - 1).drop_columns(["doc_id", "line"]).to_pylist()

    for size in (3, SHORT, 40):
        line = prose(8, size, "abcdefghijklmnopqrstuvwxyz")
        assert read([line]) == read([prose(9, 50), "x\ny z \u4e8c\u4e09\u4e94\u4e8c", prose(1, 90) + "\n" + line])
        assert read([line])[0]["chars"] == len(line)


def test_keys_are_shuffled_once_for_ranges_and_join(spark):
    rows = [(i, 4, [i % 7, 2, 3, 4], 20) for i in range(40)]
    path = f"{tempfile.mkdtemp()}/lines"
    spark.createDataFrame(rows, "id long, words int, blocks array<int>, chars int").write.parquet(path)
    lines = spark.read.parquet(path)
    members = line_dedup._members(lines)
    shared = members.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    found = members.join(shared, "bucket").select("bucket", "low", "id").distinct().join(lines.select("id", "chars"), "id")
    assert found.count() > 40
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert len(dealt) == 2 and sum("ReusedExchange" in line for line in dealt) == 1
