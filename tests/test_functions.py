"""Normalisers on the edge values, as Columns and as SQL functions."""

import hashlib
import unicodedata

import pytest
from helpers import FAILED_QUERY

from goldenrec.functions import documents as D
from goldenrec.functions import normalize as N

CASES = [
    (
        N.clean_doc,
        "clean_doc",
        {"265.423.511-40": "26542351140", "": None, None: None, "abc": None, "١٢٣": None},
    ),
    (
        N.doc_kind,
        "doc_kind",
        {"26542351140": "CPF", "1" * 14: "CNPJ", "123": None, None: None},
    ),
    (
        N.person_type,
        "tipo_pessoa_from_doc",
        {"26542351140": "PF", "1" * 14: "PJ", "123": None, None: None},
    ),
    (
        N.doc_valid,
        "doc_valid",
        {"26542351140": True, "1" * 11: False, "0" * 14: False, "123": False, None: None},
    ),
    (
        N.to_e164,
        "to_e164",
        {
            "(11) 91234-5678": "+5511912345678",
            "5511912345678": "+5511912345678",
            "1134567890": "+551134567890",
            "441234567890": "+441234567890",
            "91234-5678": None,
            "12345678901234": None,
            "": None,
            None: None,
        },
    ),
    (
        N.clean_email,
        "clean_email",
        {
            " A@B.com ": "a@b.com",
            "\u00a0a@b.com\u3000": "a@b.com",
            "a@b": None,
            "a@b.c\n": None,
            "a b@c.d": None,
            "a@@c.d": None,
            "": None,
            None: None,
        },
    ),
    (
        N.clean_name,
        "clean_nome",
        {"  A   B ": "A B", "": None, "   ": None, "\tA": " A", "A\n\tB": "A B", "\u00a0 A\u00a0B\u2003": "A\u00a0B", "joão": "joão", None: None},
    ),
    (
        N.clean_uf,
        "clean_uf",
        {" sp ": "SP", "sp\u00a0": "SP", "SPO": None, "XX": "XX", "": None, None: None},
    ),
]


@pytest.mark.parametrize(("function", "name", "cases"), CASES, ids=[c[1] for c in CASES])
def test_normalizer(evaluate, spark, function, name, cases):
    assert evaluate(function, list(cases)) == list(cases.values())
    N.register_sql_functions(spark)
    frame = spark.createDataFrame(list(enumerate(cases)), "i int, v string")
    found = frame.selectExpr("i", f"{name}(v) as r").orderBy("i").collect()
    assert [row["r"] for row in found] == list(cases.values())


def test_record_id_is_null_for_a_null_key(evaluate):
    ids = evaluate(lambda c: N.record_id("empresa_a", c), ["3", None])
    assert ids == [hashlib.md5(b"empresa_a|3").hexdigest(), None]


def test_sql_record_id(spark):
    N.register_sql_functions(spark)
    row = spark.sql("select id_unicad('empresa_a', '3') a, id_unicad('empresa_a', null) b").first()
    assert (row.a, row.b) == (hashlib.md5(b"empresa_a|3").hexdigest(), None)


def test_address(evaluate):
    texts = [
        "Rua X, 12 - Centro, Ji-Paraná - RO",
        "Rua 12 - Centro",
        "Rua X, 12 - Vila - SP",
        "Rua X, 1 - A, Belém - pa  ",
        "Rua X, 1 - A, Belém - PA\n",
        None,
    ]
    assert evaluate(N.address_uf, texts) == ["RO", "", "SP", "pa", "PA", None]
    assert evaluate(N.address_city, texts) == ["Ji-Paraná", "", "12 - Vila", "Belém", "Belém", None]


def test_json_text(evaluate, spark):
    texts = ['{"k": " v "}', '{"k": null}', "{}", '{"k": 7}', '{"k": {"a": 1}}', None, '{"k": "v"']
    assert evaluate(lambda c: N.json_text(c, "k"), texts) == [" v ", None, None, "7", '{"a":1}', None, None]
    assert evaluate(lambda c: N.json_text(c, "k", strict=True), texts[:6])[0] == " v "
    with pytest.raises(FAILED_QUERY):
        evaluate(lambda c: N.json_text(c, "k", strict=True), texts)


def test_pack_json_keeps_nulls(spark):
    frame = spark.createDataFrame([("é", None)], "a string, b string")
    assert frame.select(N.pack_json("a", "b")).first()[0] == '{"a":"é","b":null}'


def test_mask(evaluate):
    texts = ["26542351140", "12345678000195", "123", None]
    assert evaluate(D.mask_doc, texts) == ["265.423.511-40", "12.345.678/0001-95", "123", None]


def _reference_digits(base: str) -> str:
    """Check digits by the published mod-11 rule, one digit after the other."""
    for _ in range(2):
        size = len(base)
        if size < 12:
            weights = range(size + 1, 1, -1)
        else:
            weights = [2 + (size - 1 - i) % 8 for i in range(size)]
        rest = sum(int(d) * w for d, w in zip(base, weights)) % 11
        base += str(0 if rest < 2 else 11 - rest)
    return base


def test_check_digits(evaluate):
    bases = [f"{i * 7919 % 10**9:09d}" for i in range(300)]
    bases += [f"{i * 104729 % 10**12:012d}" for i in range(300)]
    full = [_reference_digits(b) for b in bases]
    assert evaluate(D.complete_doc, bases) == full
    assert all(evaluate(D.check_digits_ok, full))
    wrong = [d[:-1] + str((int(d[-1]) + 1) % 10) for d in full]
    assert not any(evaluate(D.check_digits_ok, wrong))
    assert evaluate(D.check_digits_ok, ["529.982.247-25", "123", None]) == [False, False, None]
    assert evaluate(D.check_digits_ok, ["52998224725", "11222333000181"]) == [True, True]


def test_deaccent_equals_nfd(evaluate):
    letters = "".join(chr(c) for c in range(0x20, 0x250)) + "Ji-Paraná ÇÃO ệ é"
    plain = "".join(c for c in unicodedata.normalize("NFD", letters) if unicodedata.category(c) != "Mn")
    assert evaluate(D.deaccent, [letters]) == [plain]
    assert evaluate(D.strip_punct, ["1.2-3"]) == ["123"]
