"""Removed words against the definition, window by window."""

import re
from collections import Counter

from goldenrec.llm.substrings import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(texts):
    last = 2**63
    words = [(last if d is None else d, d, WORD.findall(t or "")) for d, t in texts]
    first = {}
    for order, _, own in words:
        for i in range(len(own) - 12):
            key = tuple(own[i : i + 13])
            first[key] = min(first.get(key, last), order)
    rows = []
    for order, d, own in words:
        gone = set()
        for i in range(len(own) - 12):
            if first[tuple(own[i : i + 13])] < order:
                gone.update(range(i, i + 13))
        rows.append((d, len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    return Counter(rows)


def test_against_all_windows(docs, texts):
    found = Counter(tuple(r) for r in remove_repeats(docs).collect())
    assert found == expected(texts)
    assert sum(n for (_, _, n, _), _ in zip(found, found.values(), strict=True)) > 300


def test_texts_are_shuffled_once(spark, docs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = remove_repeats(docs)
        found.collect()
        assert "ReusedExchange" in found._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty(no_docs):
    assert remove_repeats(no_docs).count() == 0
