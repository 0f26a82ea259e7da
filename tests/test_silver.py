"""Newest rows and the seven source specs."""

import json

import pytest
from pyspark.sql import functions as F

from goldenrec.operators.latest import latest_per_key
from goldenrec.operators.standardize import SPECS, standardize
from goldenrec.schemas import BRONZE, SILVER
from helpers import FAILED_QUERY, RUN_TS, as_set

META = {"_source": "s", "_ingested_at": "2024-01-01T00:00:00+00:00", "_batch_id": "b"}


def bronze(spark, key, *rows):
    layout = BRONZE[key]
    full = [tuple({**META, **row}.get(f.name) for f in layout) for row in rows]
    return spark.createDataFrame(full, layout)


def std(spark, key, *rows, strict=False):
    return standardize(bronze(spark, key, *rows), SPECS[key], RUN_TS, strict)


def test_newest_batch_wins_and_repeats_vanish(spark):
    rows = [
        (1, "old", "2024-01-01", "b1"),
        (1, "new", "2024-01-02", "b2"),
        (1, "new", "2024-01-02", "b2"),
        (None, "x", "2024-01-01", "b1"),
        (None, "y", "2024-01-03", "b1"),
    ]
    frame = spark.createDataFrame(rows, "id int, v string, _ingested_at string, _batch_id string")
    found = {(r.id, r.v) for r in latest_per_key(frame, ["id"]).collect()}
    assert found == {(1, "new"), (None, "y")}


def test_ties_fall_the_same_way_in_every_layout(spark):
    rows = [(i % 7, f"v{i % 5}", i % 3, "2024-01-01", "b") for i in range(400)]
    frame = spark.createDataFrame(rows, "id int, v string, n int, _ingested_at string, _batch_id string")
    one = as_set(latest_per_key(frame.repartition(1), ["id"]))
    many = as_set(latest_per_key(frame.repartition(17, "n"), ["id"]))
    assert one == many
    assert len(one) == 7


def test_relational(spark):
    key = ("empresa_a", "clientes")
    rows = [
        {"id": 1, "cpf_cnpj": "265.423.511-40", "nome_razao_social": "  Ana   Sá ", "email": " A@B.com ", "status": "ativo"},
        {"id": 2, "tipo_pessoa": "PJ", "cpf_cnpj": "265.423.511-40", "endereco_uf": " sp "},
        {"id": 3, "cpf_cnpj": "11111111111111"},
        {"id": 4},
    ]
    found = {r.id_origem: r for r in std(spark, key, *rows).collect()}
    assert (found["1"].tipo_pessoa, found["2"].tipo_pessoa, found["3"].tipo_pessoa) == ("PF", "PJ", "PJ")
    assert (found["1"].nome_razao_social, found["1"].email, found["2"].uf) == ("Ana Sá", "a@b.com", "SP")
    assert (found["1"].cpf_cnpj_valido, found["3"].cpf_cnpj_valido, found["4"].cpf_cnpj_valido) == (True, False, None)
    extras = json.loads(found["1"].atributos_extras)
    assert extras["status"] == "ativo" and extras["endereco_rua"] is None
    assert list(extras) == [
        "endereco_rua", "endereco_numero", "endereco_bairro", "endereco_cep", "data_cadastro", "status", "updated_at"
    ]


def test_crm_has_no_document_and_says_not_valid(spark):
    row = std(spark, ("empresa_b", "clientes"), {"client_id": 9, "full_name": "Ana", "phone": "5511912345678"}).first()
    assert (row.cpf_cnpj, row.cpf_cnpj_kind, row.cpf_cnpj_valido) == (None, None, False)
    assert (row.tipo_pessoa, row.cidade, row.uf, row.telefone_principal) == ("PF", None, None, "+5511912345678")


def test_documents(spark):
    key = ("empresa_c", "fornecedores")
    rows = [
        {"_id": "a", "endereco": '{"cidade": " São  Paulo ", "uf": "sp"}'},
        {"_id": "b", "endereco": '{"cidade": null}'},
        {"_id": "c"},
        {"_id": "d", "endereco": '{"cidade": "x"'},
    ]
    found = {r.id_origem: (r.cidade, r.uf, r.tipo_pessoa) for r in std(spark, key, *rows).collect()}
    assert found == {
        "a": ("São Paulo", "SP", "PJ"),
        "b": (None, None, "PJ"),
        "c": (None, None, "PJ"),
        "d": (None, None, "PJ"),
    }
    with pytest.raises(FAILED_QUERY):
        std(spark, key, *rows, strict=True).collect()


def test_spreadsheet_ids(spark):
    key = ("empresa_d", "clientes")
    rows = [
        {"Nome": " Ana ", "Documento": "265.423.511-40", "Endereco": "Rua X, 12 - Centro, Ji-Paraná - RO"},
        {"Nome": " Ana ", "Documento": "26542351140"},
        {"Nome": " Ana ", "Documento": "26542351140"},
        {"Nome": "Bia", "Documento": ""},
    ]
    found = std(spark, key, *rows).collect()
    assert len(found) == 3
    ana = [r for r in found if r.nome_razao_social == "Ana"]
    assert len({r.id_unicad for r in ana}) == 1 and {r.id_origem for r in ana} == {"26542351140"}
    bia = next(r for r in found if r.nome_razao_social == "Bia")
    assert (bia.id_unicad, bia.id_origem, bia.cpf_cnpj_valido) == (None, None, None)
    assert {(r.cidade, r.uf) for r in found} == {("Ji-Paraná", "RO"), (None, None)}


def test_api_person_type_defaults_to_natural(spark):
    key = ("empresa_e", "clientes")
    rows = [{"id": "1", "type": "business"}, {"id": "2", "type": "individual"}, {"id": "3"}]
    found = {r.id_origem: r.tipo_pessoa for r in std(spark, key, *rows).collect()}
    assert found == {"1": "PJ", "2": "PF", "3": "PF"}


@pytest.mark.parametrize("key", list(SPECS), ids=lambda k: "_".join(k))
def test_every_spec_fills_the_contract(spark, key):
    frame = std(spark, key, {})
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in SILVER]
    assert frame.select(F.first("_processed_at")).first()[0] is not None
