"""Phrase counts and scores against dictionaries of Python."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from goldenrec.llm.phrases import Deal, Leaves, _pack, _score, _unpack, collocations, count_phrases, suffixes
from goldenrec.llm.words import slices


def pieces(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall(r"[^ \t]+", piece) for piece in re.split(r"[.,;:!?\n-\r]", lower)]


def brute_counts(rows):
    counts = Counter()
    for lang, text in rows:
        for words in pieces(text):
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[("und" if lang is None else lang, *words[i : i + size])] += 1
    return counts


def brute(rows, least=10, reported=2000):
    f = brute_counts(rows)
    n = Counter()
    for key, count in f.items():
        if len(key) == 2:
            n[key[0]] += count
    longer = Counter()
    for key, count in f.items():
        if len(key) == 4 and count >= least:
            for inner in (key[:3], (key[0], *key[2:])):
                longer[inner] = max(longer[inner], count)
    found = {}
    for key, a in f.items():
        if len(key) < 3 or a < least or (len(key) == 3 and 100 * longer[key] >= 50 * a):
            continue
        cuts = []
        for k in range(2, len(key)):
            left, right = f[key[:k]], f[(key[0], *key[k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(key[0], []).append((-score, -a, " ".join(key[1:]).encode(), left, right))
    return [
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, best in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:reported], 1)
    ]


def corpus():
    rng = random.Random(3)
    vocabulary = ["the", "of", "Zebra", "ünï", "a", "x-y", "日本", "<b>", "of\x00"]
    rows = []
    for i in range(150):
        words = [rng.choice(vocabulary[: 3 + i % 7]) for _ in range(rng.randint(0, 60))]
        signs = [rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ":", " ."]) for _ in words]
        rows.append((rng.choice(["en", "de", None, "und", ""]), "".join(w + s for w, s in zip(words, signs))))
    rows += [("en", "New York City is big! " * 30), ("en", "a a a a a a " * 40), ("fr", None), ("fr", ""), (None, " \t.,")]
    return rows + [("en", "hot word pair " * 3000)] + rows[:5]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, text, lang, 7) for i, (lang, text) in enumerate(corpus())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, first long").repartition(4)


# the smaller the budget, the longer the prefixes that part the groups
@pytest.mark.parametrize("budget", [1 << 21, 1000, 30])
def test_against_dictionaries(frame, budget):
    got = collocations(frame, budget=budget).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(corpus()))


def test_counts_of_words_phrases_and_languages(frame):
    got = {(r.lang, *(w for w in (r.first, r.second, r.third) if w)): r.f for r in count_phrases(frame, 3, 200).collect()}
    counts = brute_counts(corpus())
    for key, f in list(counts.items()):
        if len(key) == 2:
            counts[key[:1]] += f
    assert got == {key: f for key, f in counts.items() if f >= 3 or len(key) == 1}


def test_limits_and_empty(frame, spark):
    got = collocations(frame, reported=4).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(corpus(), reported=4))
    assert collocations(frame.where("false")).count() == 0
    blank = spark.createDataFrame([(1, None, "en"), (2, " .", None)], "doc_id long, text string, lang string")
    assert collocations(blank).count() == 0


def test_groups_are_filled_up_to_the_budget():
    sizes = np.array([0, 3, 4, 5, 30, 1, 0, 9, 2])
    deal = Deal.packed(sizes, 10)
    assert deal.pieces.tolist() == [1, 1, 1, 1, 6, 1, 1, 1, 1]
    assert deal.base[[1, 2, 3, 4, 5, 7, 8]].tolist() == [0, 0, 1, 2, 8, 8, 9]


def test_scores_beyond_64_bits(spark):
    rows = [(10**13, 10**13, 3 * 10**13), (2**40, 2**41, 2**40), (10, 11, 13)]
    frame = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in frame.select(_score("a", "l", "r")).collect()]
    assert got == [1000000 * a * a // (left * right) for a, left, right in rows]


def test_packed_leaves_come_back():
    texts = ["the cat, the dog. the cat sat", "Ünï 日本 \t x"] * 3
    (part,) = slices(pa.array(texts))
    leaves = suffixes(part, pa.array(["en", ""] * 3, pa.large_utf8()))
    again = Leaves.unpacked(leaves.packed(np.arange(len(leaves))))

    def spelled(x):
        words = ["", *x.words.to_pylist()]
        lang, first, second, third, total = (c.tolist() for c in x.columns)
        return sorted((x.langs[a].as_py(), words[b + 1], words[c], words[d], e) for a, b, c, d, e in zip(lang, first, second, third, total))

    assert spelled(again) == spelled(leaves)
    arrays = [np.array([], np.int64), np.array([-5, 2**40]), np.array([7, 7, 7]), np.array([1, 255], np.uint8)]
    assert [x.tolist() for x in _unpack(_pack(arrays))] == [x.tolist() for x in arrays]
