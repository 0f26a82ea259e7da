"""Normalisers against DuckDB on odd random texts."""

import random

import duckdb
import pandas as pd
import pytest

import oracle
from goldenrec.functions import documents as D
from goldenrec.functions import normalize as N

ALPHABET = list("0123456789" * 3 + "aAbBzZçÇãÉñ@@..--,,  ()+_%'\"\\/") + ["\t", "\n", "\r", "\x0b", "\f", " ", " ", "٣", "😀"]
SHAPES = ("{0}@{1}.{2}", "Rua {0}, {1} - {2}, {0} - SP", "{0}, {1} - ab{2}", " {0}{1}", "({0}) {1}-{2}", "{0}")


def texts():
    draw = random.Random(7)

    def word(most):
        return "".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, most)))

    found = [draw.choice(SHAPES).format(word(8), word(6), word(5)) for _ in range(6000)]
    found += ["".join(draw.choice("0123456789") for _ in range(draw.choice((10, 11, 12, 13, 14)))) for _ in range(500)]
    found += [str(d) * n for d in range(10) for n in (11, 14)] + ["", " ", None]
    return found


PAIRS = {
    "doc": (N.clean_doc, oracle.doc),
    "kind": (lambda c: N.doc_kind(N.clean_doc(c)), lambda x: oracle.kind(oracle.doc(x))),
    "person": (lambda c: N.person_type(N.clean_doc(c)), lambda x: oracle.person(oracle.doc(x))),
    "valid": (lambda c: N.doc_valid(N.clean_doc(c)), lambda x: oracle.valid(f"({oracle.doc(x)})")),
    "phone": (N.to_e164, oracle.phone),
    "email": (N.clean_email, oracle.email),
    "name": (N.clean_name, oracle.name),
    "uf": (N.clean_uf, oracle.uf),
    "address_uf": (N.address_uf, oracle.address_uf),
    "address_city": (N.address_city, oracle.address_city),
    "accents": (D.deaccent, lambda x: f"strip_accents({x})"),
}


@pytest.mark.parametrize("name", PAIRS)
def test_same_answer(evaluate, name):
    function, sql = PAIRS[name]
    values = texts()
    frame = pd.DataFrame({"i": range(len(values)), "v": pd.Series(values, dtype=object)})  # noqa: F841
    wanted = [r[0] for r in duckdb.sql(f"select {sql('v')} from frame order by i").fetchall()]
    found = evaluate(function, values)
    wrong = [(v, a, b) for v, a, b in zip(values, found, wanted, strict=True) if a != b]
    assert wrong == []
