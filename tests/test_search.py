"""Search, pages, details and entity lookup."""

import pytest
from pyspark.sql import functions as F

from goldenrec.operators import paging, search
from goldenrec.operators.golden import build_golden
from goldenrec.operators.resolve import resolve_entities
from helpers import RUN_TS, silver

DOC = "26542351140"


@pytest.fixture(scope="module")
def clustered(spark):
    rows = [
        {"cpf_cnpj": DOC, "nome_razao_social": "Ana Araújo", "email": "ana@x.y", "cidade": "Belém", "uf": "PA"},
        {"cpf_cnpj": DOC, "fonte": "empresa_e", "email": "ana2@x.y", "telefone_principal": "+5511912345678"},
        {"nome_razao_social": None, "tipo_pessoa": None},
        {"nome_razao_social": "100% Anatel", "cidade": "Belém", "uf": "SP"},
        {"nome_razao_social": "back\\slash"},
    ]
    rows += [{"nome_razao_social": f"Zé {i:03d}", "uf": "RO"} for i in range(30)]
    return resolve_entities(silver(spark, *rows)).cache()


@pytest.fixture(scope="module")
def tables(clustered):
    return build_golden(clustered, RUN_TS)


def find(tables, **options):
    return search.search(tables, **options)


def names(page):
    return [r.nome_razao_social for r in page.data.collect()]


def test_filters(tables):
    assert names(find(tables, q="ANA")) == ["Ana Araújo", "100% Anatel"]
    assert names(find(tables, doc="265.423.511-40")) == ["Ana Araújo"]
    assert names(find(tables, email="ANA2@")) == ["Ana Araújo"]
    assert names(find(tables, telefone="(11) 9123")) == ["Ana Araújo"]
    assert names(find(tables, cidade="belém")) == ["Ana Araújo", "100% Anatel"]
    assert names(find(tables, cidade="belém", uf="sp")) == ["100% Anatel"]
    assert names(find(tables, uf="sp", email="ana")) == []


def test_wildcards_and_backslashes(tables):
    assert names(find(tables, q="a%araújo")) == ["Ana Araújo"]
    assert names(find(tables, q="back\\s")) == ["back\\slash"]


def test_useless_parameters_do_not_filter(tables):
    everything = find(tables).total
    for options in ({"doc": "abc"}, {"telefone": "--"}, {"q": ""}, {"email": ""}, {"cidade": "", "uf": ""}):
        assert find(tables, **options).total == everything


def test_pages(tables):
    first, second, past = (find(tables, page=p, per_page=20) for p in (1, 2, 3))
    assert (first.total, first.has_next, second.has_next, past.has_next) == (34, True, False, False)
    shown = names(first) + names(second)
    assert len(shown) == 34 and shown[0] == "Ana Araújo" and shown[-1] is None
    assert names(past) == []
    assert first.data.columns == list(search.SUMMARY)


def test_deep_pages_equal_shallow_ones(tables, monkeypatch):
    shallow = [names(find(tables, page=p, per_page=7)) for p in range(1, 7)]
    monkeypatch.setattr(paging, "TOP_N_LIMIT", 0)
    assert [names(find(tables, page=p, per_page=7)) for p in range(1, 7)] == shallow


@pytest.mark.parametrize("options", [{"page": 0}, {"per_page": 0}, {"per_page": 101}, {"uf": "SPX"}])
def test_bad_parameters(tables, options):
    with pytest.raises(ValueError):
        find(tables, **options)


def test_detail(clustered):
    golden = build_golden(clustered, RUN_TS)
    ana = search.search(golden, doc=DOC).data.first()
    row = search.detail(golden, ana.id_golden)
    assert list(row.asDict()) == list(search.DETAIL)
    assert row.primeira_aparicao.isoformat().startswith("2024-01-01T00:00:00")
    nobody = search.search(golden, q="back").data.first()
    assert (nobody.emails, nobody.telefones, nobody.enderecos) == ([], [], [])
    assert search.detail(golden, "missing") is None


def test_company_in_both_registries(spark, clustered):
    customers = build_golden(clustered, RUN_TS)
    suppliers = customers.where(F.col("cpf_cnpj") == DOC).withColumn("nome_razao_social", F.lit("fornecedor"))
    key = suppliers.first().id_golden
    assert search.resolve_entity(customers, suppliers, key).nome_razao_social == "Ana Araújo"
    assert search.resolve_entity(customers.limit(0), suppliers, key).nome_razao_social == "fornecedor"
    assert search.resolve_entity(customers, suppliers, "missing") is None
    both = search.resolve_entity_all(customers, suppliers, key).collect()
    assert {r.registro for r in both} == {"clientes", "fornecedores"}
    assert tuple(search.health(customers, suppliers).first()) == ("ok", 34, 1)


def test_global_positions(spark):
    frame = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5003).alias("v"))
    rows = paging.global_position(frame, paging.in_order("v")).collect()
    ranked = [r.v for r in sorted(rows, key=lambda r: r.posicao)]
    assert ranked == sorted(ranked) and [r.posicao for r in sorted(rows, key=lambda r: r.posicao)] == list(range(1, 5001))


def test_envelopes(spark):
    frame = spark.range(53).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    pages = {r.page: r for r in paging.page_envelopes(frame, "k", 25).collect()}
    assert sorted(pages) == [1, 2, 3]
    assert [len(pages[p].data) for p in (1, 2, 3)] == [25, 25, 3]
    assert [pages[p].has_next for p in (1, 2, 3)] == [True, True, False]
    assert (pages[2].data[0].k, pages[2].data[0].v, pages[2].total, pages[2].per_page) == (25, 50, 53, 25)
    assert paging.page_envelopes(frame.where("k < 50"), "k", 25).where("has_next").count() == 1


def test_stored_ranks_give_the_same_pages(spark, tables, tmp_path):
    rows = tables.select("id_golden", "score_completude", "nome_razao_social", "emails").cache()
    root = str(tmp_path / "ranked")
    for size in (1000, 4, 1):
        ranked = paging.Ranked.build(rows, root, "id_golden", search.RANKING, size)
        assert ranked.total == rows.count()
        for page, per_page in ((1, 5), (2, 7), (5, 7), (34, 1), (1, 100), (99, 10)):
            wanted = paging.page_of(rows, page, per_page, "id_golden", search.RANKING).collect()
            assert ranked.page(page, per_page).collect() == wanted
    # ranges, and folders read for a page within one of them
    plan = ranked.page(20, 1)._jdf.queryExecution().executedPlan().toString()
    assert len(ranked.starts) > 10 and "PartitionFilters: [isnotnull(faixa" in plan
    with pytest.raises(FileNotFoundError):
        paging.Ranked(spark, str(tmp_path / "none"))
    assert paging.Ranked.build(rows.where("false"), root, "id_golden", search.RANKING).page(1, 3).count() == 0
