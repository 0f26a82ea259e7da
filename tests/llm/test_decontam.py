"""Hits against every window of every item, tried at every place."""

import re
from collections import Counter

import pytest

from goldenrec.llm.decontam import find_contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def expected(texts, items):
    found = []
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(len(own), 10)
        for i in range(len(own) - size + 1 if size else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add("" if item is None else str(item))
    for d, text in texts:
        own = words(text)
        hit, names = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                if names_here := windows.get(tuple(own[i : i + size])):
                    hit.update(range(i, i + size))
                    names |= names_here
        found.append((d, len(own), len(hit), tuple(sorted(names))))
    return Counter(found)


@pytest.mark.parametrize("block", [100_000, 7])
def test_against_all_windows(spark, docs, texts, block):
    long = texts[0][1].split(" ")
    items = [
        (1, " ".join(long[5:30])),
        (2, " ".join(long[5:30]).upper() + "!"),
        (10, "one, two"),
        (11, None),
        (12, "?!"),
        (13, "a a a a a a a a a a a a"),
        (None, texts[2][1]),
        (1, " ".join(long[5:30])),
        (15, "ünï cödé wörds ünï cödé"),
        (16, "nothing like this is in any text of the fixture at all"),
    ]
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_hit string")
    found = find_contamination(docs, frame, block).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found) == expected(texts, items)
    assert {r.lang for r in found} == {"en"}


def test_items_of_one_id_and_different_length(spark):
    own = [f"w{i}" for i in range(40)]
    items = [("a", " ".join(own[:10])), ("a", " ".join(own[2:8])), ("a", " ".join(own[9:12])), ("b", " ".join(own[4:24]))]
    items += [(None, " ".join(own[20:32])), (None, " ".join(own[21:24])), ("c", " ".join(own[30:34])), ("c", " ".join(own[36:38]))]
    texts = [(1, " ".join(own[:10])), (2, " ".join(own)), (3, " ".join(own[2:8] + ["x"] + own[:10])), (4, " ".join(own[::-1]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = find_contamination(docs, spark.createDataFrame(items, "item_id string, text string")).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found) == expected(texts, items)


def test_empty_tables(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "some words to look for")], "item_id long, text string")
    assert find_contamination(no_docs, items).count() == 0
    assert find_contamination(docs, items.limit(0)).where("n_hit > 0").count() == 0
