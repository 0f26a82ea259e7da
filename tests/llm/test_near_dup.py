"""Near duplicates against all pairs of full shingle sets."""

import random
from collections import Counter

from pyspark.sql import functions as F

from goldenrec.llm import near_dup
from goldenrec.llm.links import Scratch, components, star_groups
from goldenrec.llm.near_dup import near_duplicates


def shingles(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in lower.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(texts):
    sets = [shingles(t) for _, t in texts]
    group = list(range(len(texts)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                group[find(a)] = find(b)
    members = {}
    for place, (doc_id, _) in enumerate(texts):
        members.setdefault(find(place), []).append(doc_id)
    rows = []
    for place, (doc_id, _) in enumerate(texts):
        ids = [i for i in members[find(place)] if i is not None]
        head = min(ids) if ids else None
        rows.append((doc_id, len(sets[place]), head if sets[place] else doc_id))
    return Counter(rows)


def test_against_all_pairs(docs, texts):
    found = near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == expected(texts)
    for row in found:
        if row.doc_id is not None:
            assert row.kept == (row.doc_id == row.component_id)
    # a text without id stays if nothing with an id is like it, and so does the NULL text
    assert sum(r.kept for r in found if r.doc_id is None) == 2


def test_empty(no_docs):
    assert near_duplicates(no_docs).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(60)]
    hub = [(100, 101 + i) for i in range(50)] + [(300, 150)]
    links = spark.createDataFrame(chain + hub, "a long, b long")
    scratch = Scratch(spark)
    found = {r.id: r.component for r in components(links, scratch).collect()}
    scratch.clear()
    assert {found[i] for i in range(61)} == {0}
    assert {found[i] for i in [*range(100, 151), 300]} == {100}


def test_star_rounds_lose_no_group(spark):
    """Bucket members that are like their neighbours but not like the first centre."""
    size = 40
    members = spark.createDataFrame([(1, i) for i in range(size)] + [(2, 7), (2, 99)], "bucket long, id long")
    infos = spark.range(100).withColumn("info", F.lit(0))
    asked = []

    def confirm(pairs):
        asked.append(pairs.count())
        return pairs.where("b - a = 2")

    groups, _ = star_groups(members, infos, lambda one, other: one == other, confirm)
    found = {r.id: r.component for r in groups.collect()}
    assert found == {i: i % 2 for i in range(size)}
    assert sum(asked) <= size * size / 2


def test_pairs_of_a_group_that_shares_bands_and_does_not_link(spark, monkeypatch):
    """Near copies with few to many changed words: most links go to the middle, the rest need not be tried."""
    rng = random.Random(7)
    vocabulary = ["w%d" % i for i in range(60)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    rows = []
    for doc_id in range(400):
        words = base if doc_id % 20 else list(rows[doc_id - 3][1]) if doc_id else base
        words = list(words)
        for place in rng.sample(range(len(words)), min(int(rng.expovariate(1 / 4)), 14) if doc_id % 20 else 1):
            words[place] = rng.choice(vocabulary)
        rows.append((doc_id, words))
    texts = [(doc_id, " ".join(words)) for doc_id, words in rows]
    asked = []

    def counted(members, infos, close, confirm, *more):
        def counting(pairs):
            asked.append(pairs.count())
            return confirm(pairs)

        return star_groups(members, infos, close, counting, *more)

    monkeypatch.setattr(near_dup, "star_groups", counted)
    found = near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    wanted = expected(texts)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == wanted
    # some stay outside the large group, and several of these link with each other
    sizes = sorted(Counter(component for _, _, component in wanted.elements()).values())
    assert sizes[-1] < 330 and sizes[0] == 1 and sizes[-2] > 1
    # beyond the two rounds of one centre a bucket; 3,023 by the size of the sets and their own shingles alone
    assert sum(asked[2:]) < 400
