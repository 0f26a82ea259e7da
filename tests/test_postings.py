"""Searches by stored postings against searches of the golden table."""

import re

import pytest
from pyspark.sql import functions as F

from goldenrec.operators import postings, search
from goldenrec.operators.golden import build_golden
from goldenrec.operators.postings import Index, build_index
from goldenrec.operators.resolve import resolve_entities
from helpers import RUN_TS, silver

PEOPLE = [
    {"cpf_cnpj": "26542351140", "nome_razao_social": "Ana Araújo", "email": "ana@x.y", "telefone_principal": "+5511912345678"},
    {"cpf_cnpj": "26542351140", "fonte": "empresa_e", "email": "ana2@x.y"},
    {"nome_razao_social": None, "tipo_pessoa": None},
    {"id_unicad": None, "nome_razao_social": "Sem Chave", "email": "nobody@x.y"},
    {"nome_razao_social": "100% ANATEL", "uf": "SP"},
    {"nome_razao_social": "back\\slash"},
    {"nome_razao_social": "aé", "email": "É@x.y"},
    {"nome_razao_social": "aaaaaa"},
    {"nome_razao_social": "İstanbul 𝄞𝄞𝄞"},
]


@pytest.fixture(scope="module")
def golden(spark):
    more = [{"nome_razao_social": f"Zé {i:03d} Comércio", "email": f"ze{i}@loja.com", "telefone_principal": f"+55119{i:08d}"} for i in range(60)]
    return build_golden(resolve_entities(silver(spark, *PEOPLE, *more)), RUN_TS).cache()


@pytest.fixture(scope="module")
def index(spark, golden, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("index") / "postings")
    build_index(golden.limit(3), root)
    build_index(golden, root)
    return Index(spark, root)


SEARCHES = [
    {"q": "ANA"},
    {"q": "ana%ara"},
    {"q": "ze"},
    {"q": "zé 0"},
    {"q": "ZÉ 00_ com"},
    {"q": "%"},
    {"q": "0% a"},
    {"q": "ck\\sl"},
    {"q": "aaaa"},
    {"q": "sem chave"},
    {"q": "İstan"},
    {"q": "𝄞𝄞𝄞"},
    {"q": "nothing like it"},
    {"email": "ANA2@"},
    {"email": "@x.y"},
    {"email": "é@x"},
    {"email": "ze1%com"},
    {"telefone": "(11) 9123"},
    {"telefone": "12"},
    {"telefone": "abc"},
    {"q": "comércio", "email": "loja", "telefone": "9000000"},
    {"q": "ana", "uf": "sp"},
    {"uf": "SP"},
    {},
]


@pytest.mark.parametrize("filters", SEARCHES, ids=str)
def test_same_pages(golden, index, filters):
    for page in (1, 2):
        wanted = search.search(golden, page=page, per_page=20, **filters)
        found = index.search(page=page, per_page=20, **filters)
        assert (found.total, found.has_next) == (wanted.total, wanted.has_next)
        assert found.data.collect() == wanted.data.collect()


def plan_of(frame):
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return frame._jdf.queryExecution().explainString(mode)


def test_a_search_reads_postings_and_few_folders(index):
    ids = index.ids("email", "ana2@x.y")
    assert "In(trigrama" in plan_of(ids) and "EqualTo(campo,email)" in plan_of(ids)
    (folder,) = [row[0] for row in ids.select(F.left("id_golden", F.lit(1))).collect()]
    rows = index.rows(ids)
    assert rows.count() == 1 and re.search(rf"PartitionFilters: .*pasta#\d+ (IN|=) \(?{folder}\)?\]", plan_of(rows))


def test_probes_do_not_change_the_result(golden, index, monkeypatch):
    for probes in (1, 20):
        monkeypatch.setattr(postings, "PROBES", probes)
        assert index.matches(q="comércio", email="ze5").count() == search.search_matches(golden, q="comércio", email="ze5").count() == 11


def test_no_golden_rows(spark, golden, tmp_path):
    build_index(golden.where(F.lit(False)), str(tmp_path / "none"))
    assert Index(spark, str(tmp_path / "none")).search(q="ana").total == 0
    with pytest.raises(FileNotFoundError):
        Index(spark, str(tmp_path / "absent"))


def test_long_lists_and_ids_of_any_form(spark, golden, tmp_path, monkeypatch):
    wanted = {tuple(row) for row in postings._grams(golden).collect()}
    assert len(wanted) == postings._grams(golden).count() > 100
    monkeypatch.setattr(postings, "LIST_TEXTS", 0)
    assert {tuple(row) for row in postings._grams(golden).collect()} == wanted
    assert postings._grams(golden).count() == len(wanted)
    ids = [None, "", "x", "0123456789abcdef", "AB" * 16, "ab" * 16, "é" * 16]
    packed = spark.createDataFrame([(one,) for one in ids], "id string").select("id", postings._packed(F.col("id")).alias("p"))
    assert [row.u for row in packed.select(postings._unpacked(F.col("p")).alias("u")).collect()] == ids
    # an md5 takes 16 bytes of the postings and not 32
    assert [row.n for row in packed.select(F.length("p").alias("n")).collect()][-2] == 16
