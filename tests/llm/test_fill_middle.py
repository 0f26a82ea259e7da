"""Fill-in-the-middle against a regular expression and slices of Python strings."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from goldenrec.llm.fill_middle import cut_rows, fill_in_middle, restore
from goldenrec.llm.words import slices

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def expected(doc_id, text):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    units = UNIT.findall(text or "")
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    parts = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not units or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, None, text or ""
    prefix, middle, suffix = parts
    if h4 % 100 < 20:
        return len(units), "spm", *parts, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", *parts, f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(frame, rows):
    got = fill_in_middle(frame).withColumn("again", restore(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    ours = sorted(repr((r.doc_id, r.text, r.n, r.form, r.prefix, r.middle, r.suffix, r.output)) for r in got)
    assert ours == sorted(repr((i, t, *expected(i, t))) for i, t in rows)
    assert all(r.again == (r.text or "") for r in got)
    return got


def test_against_the_expression(docs, texts):
    got = check(docs, texts)
    assert got[0].lang == "en"
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_signs_marks_and_every_length(spark):
    rng = random.Random(5)
    signs = "aZ [`{@z\x00\x1a\x7fé€𝄞\n<PSM>"
    rows = [(i, "".join(rng.choice(signs) for _ in range(i % 40))) for i in range(800)]
    rows += [(1000, "a<P>b"), (1001, "<S"), (1002, "<<S>"), (1003, "<M<M"), (1004, "P>"), (None, "<S<P")]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), rows)


def test_junctions_make_no_mark(spark):
    rows = [(i, "<S<P<M" * 4 + "P>S>M>" * 3 + "<") for i in range(200)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_every_rank_of_a_row():
    text = "aé𝄞bc d  efghijklmnop€€€qrstuvwxyz" * 3
    units = UNIT.findall(text)
    (part,) = slices(pa.array([""] + [text] * (len(units) + 1) + ["", "x"]))
    ranks = np.arange(len(units) + 1)
    draws = np.concatenate([[0], ranks, [0, 1]])
    count, cuts = cut_rows(part, np.stack([draws, np.zeros_like(draws)], axis=1))
    assert count.tolist() == [0] + [len(units)] * (len(units) + 1) + [0, 1]
    assert cuts[1:-2, 1].tolist() == [len("".join(units[:k]).encode()) for k in ranks]
    assert cuts[-1].tolist() == [0, 1]


def test_empty_and_clashing_names(spark, no_docs):
    assert fill_in_middle(no_docs).count() == 0
    clash = spark.createDataFrame([(1, "a b", "keep", 5)], "doc_id long, text string, _Low string, N long")
    (row,) = fill_in_middle(clash).collect()
    assert row["_Low"] == "keep" and row["n"] == 3
    assert fill_in_middle(clash).columns == ["doc_id", "text", "_Low", "n", "form", "prefix", "middle", "suffix", "output"]
