"""Forward-backward against all labellings, and held-out accuracy."""

import itertools
import math
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pytest

from goldenrec.llm import language
from goldenrec.llm.language import fit, forward_backward, identify, label_shares, learn
from goldenrec.llm.words import slices
from tests.llm.conftest import DOCS, prose

import pyarrow as pa

SOUNDS = {"aa": "abcde", "bb": "klmno", "cc": "uvwxyé"}


@pytest.fixture(scope="module")
def model():
    rows = [(prose(i, 80, SOUNDS[lang]), lang) for i in range(12) for lang in SOUNDS]
    return fit([t for t, _ in rows], [lang for _, lang in rows])


def test_forward_backward_against_all_paths():
    random = np.random.default_rng(1)
    scores, steps, start = random.normal(size=(3, 5, 3)), random.normal(size=(3, 3)), random.normal(size=3)
    size = np.array([5, 3, 1])
    marginal, moved, partition = forward_backward(scores, size, steps, start)
    wanted_moves = np.zeros((3, 3))
    for chain in range(3):
        total, share = 0.0, np.zeros((5, 3))
        moves = np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(size[chain])):
            weight = start[path[0]] + sum(scores[chain, i, y] for i, y in enumerate(path))
            weight = math.exp(weight + sum(steps[a, b] for a, b in itertools.pairwise(path)))
            total += weight
            for i, y in enumerate(path):
                share[i, y] += weight
            for a, b in itertools.pairwise(path):
                moves[a, b] += weight
        assert np.allclose(marginal[chain], share / total)
        assert math.isclose(partition[chain], math.log(total))
        wanted_moves += moves / total
    assert np.allclose(moved, wanted_moves)


def test_code_switched_text_is_labelled_by_words(model):
    text = " ".join([prose(100, 40, SOUNDS["aa"]), prose(101, 25, SOUNDS["bb"]), prose(102, 10, SOUNDS["cc"])])
    part = next(slices(pa.array([text])))
    shares = dict(zip(model.labels, label_shares(part, model)[0], strict=True))
    assert abs(shares["aa"] - 40 / 75) < 0.05 and abs(shares["bb"] - 25 / 75) < 0.05
    assert all(model.steps[i, i] > model.steps[i, j] for i in range(3) for j in range(3) if i != j)


def test_held_out_documents_and_edge_rows(spark):
    rows = [(i, prose(i, 60, SOUNDS[lang]), lang) for i, lang in enumerate(list(SOUNDS) * 30)]
    odd = [(900, None, "aa"), (901, "", "aa"), (902, "12 ?! 34", "bb"), (None, prose(5, 50, SOUNDS["bb"]), "cc")]
    odd += [(903, prose(7, 9, SOUNDS["cc"]), None), (904, "é" * 3, "cc"), (905, prose(8, 40_000, SOUNDS["aa"]), "aa")]
    full = [(i, t, lang, "s", 1, 2, "x", "y") for i, t, lang in rows + odd]
    docs = spark.createDataFrame(full, DOCS).withColumnRenamed("hits", "score")
    found = identify(docs, learn(docs)).collect()
    assert len(found) == len(full)
    by_id = {r.doc_id: r for r in found}
    held = [r for r in found if r.held_out]
    assert len(held) > 20
    assert all(r.lang_pred == r.lang for r in held if r.doc_id < 900)
    for doc_id in (900, 901, 902):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert by_id[None].lang_pred == "bb" and not by_id[None].held_out
    assert by_id[903].lang_pred == "cc" and by_id[905].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in found)


def test_nothing_to_learn_from(spark, docs, no_docs):
    assert learn(no_docs) is None
    assert identify(no_docs, None).count() == 0
    found = identify(docs, None).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}


def test_the_fit_does_not_hold_weights_of_all_features(monkeypatch):
    monkeypatch.setattr(language, "ROUNDS", 1)
    texts = [prose(seed, 560)[:2000] for seed in range(240)]
    language.fit(texts[:8], ["a", "b"] * 4)
    tracemalloc.start()
    language.fit(texts, ["a", "b", "c", "d"] * 60)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 120e6, peak


def _labelled(model, texts):
    """What a task makes of one batch, and the most memory it takes."""
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array(texts), pa.array([True] * len(texts))], ["doc_id", "text", "_lettered"]
    )
    run = language._predict(SimpleNamespace(value=model), ["doc_id", "text"])
    tracemalloc.start()
    # as on the way to Spark: what was made of a slice is gone before the next
    rows = [row for part in run(iter([batch])) for row in part.to_pylist()]
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    return rows, peak


def test_labelling_takes_little_memory_and_keeps_every_row(model, monkeypatch):
    texts = [prose(i, 2000, SOUNDS[lang]) for i, lang in enumerate(list(SOUNDS) * 100)]
    assert sum(map(len, texts)) > 2e6
    _labelled(model, texts[:3])
    found, peak = _labelled(model, texts)
    assert peak < 80e6, peak
    assert [(r["doc_id"], r["text"], r["lang_pred"]) for r in found] == [(i, t, list(SOUNDS)[i % 3]) for i, t in enumerate(texts)]
    monkeypatch.setattr(language, "LABEL_BYTES", 1 << 23)
    whole, most = _labelled(model, texts)
    assert most > 2 * peak
    assert [r["lang_pred"] for r in whole] == [r["lang_pred"] for r in found]
    assert max(abs(a["score"] - b["score"]) for a, b in zip(whole, found, strict=True)) < 1e-6


@pytest.mark.parametrize("name", ["text", "Text"])
def test_texts_go_to_the_workers_once(spark, no_docs, name):
    docs = no_docs.withColumnsRenamed({"text": name})
    plan = identify(docs, None)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "MapInArrow":
        plan = plan.children().head()
    sent = plan.child().output()
    assert [sent.apply(i).dataType().typeName() for i in range(sent.size())].count("string") == [f.dataType.typeName() for f in docs.schema].count("string")
    assert identify(docs, None).columns[: len(docs.columns)] == docs.columns
