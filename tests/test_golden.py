"""Entity resolution and golden records."""

import pytest
from pyspark.sql import functions as F

from goldenrec.operators import golden as golden_operators
from goldenrec.operators.golden import build_golden, build_golden_by_size, id_conflicts, list_entries, list_rows
from goldenrec.operators.resolve import email_owners, resolve_entities
from goldenrec.plans import queries
from goldenrec.schemas import CLUSTER, GOLDEN
from goldenrec.session import stage
from helpers import FAILED_QUERY, RUN_TS, as_set, silver

DOC1, DOC2 = "26542351140", "36542351140"


def keys(frame):
    return {r.id_unicad: (r.cluster_key, r.match_method) for r in resolve_entities(frame).collect()}


def test_three_levels(spark):
    found = keys(
        silver(
            spark,
            {"cpf_cnpj": DOC1, "email": "a@x.y"},
            {"cpf_cnpj": DOC2, "email": "a@x.y"},
            {"email": "a@x.y", "cpf_cnpj_valido": False},
            {"email": "a@x.y", "cpf_cnpj": "11111111111", "cpf_cnpj_valido": False},
            {"email": "s@x.y"},
            {"email": "s@x.y"},
            {},
            {"cpf_cnpj": DOC1},
        )
    )
    assert found == {
        "u0": ("doc:" + DOC1, "doc_match"),
        "u1": ("doc:" + DOC2, "doc_match"),
        # one address of two documents belongs to the smaller key; it does not join the documents
        "u2": ("doc:" + DOC1, "email_to_doc_match"),
        "u3": ("doc:" + DOC1, "email_to_doc_match"),
        # records without a document never join through an address
        "u4": ("lone:u4", "singleton"),
        "u5": ("lone:u5", "singleton"),
        "u6": ("lone:u6", "singleton"),
        "u7": ("doc:" + DOC1, "doc_match"),
    }


def test_no_id_no_match_has_no_key(spark):
    frame = resolve_entities(silver(spark, {"id_unicad": None}, {"id_unicad": None, "email": "z@z.z"}))
    assert {(r.cluster_key, r.match_method) for r in frame.collect()} == {(None, "singleton")}
    assert frame.schema == CLUSTER or [f.name for f in frame.schema] == CLUSTER.fieldNames()


def test_owners_are_unique(spark):
    frame = silver(spark, *[{"cpf_cnpj": d, "email": "a@x.y"} for d in (DOC2, DOC1, DOC2)])
    assert [tuple(r) for r in email_owners(frame).collect()] == [("a@x.y", "doc:" + DOC1)]


def test_hot_address_is_split(spark):
    """A third of the rows share one address: the join still gives every row its cluster."""
    rows = [{"cpf_cnpj": DOC1, "email": "hot@x.y"}]
    rows += [{"email": "hot@x.y"} if i % 3 == 0 else {"email": f"e{i}@x.y"} for i in range(3000)]
    found = resolve_entities(silver(spark, *rows)).groupBy("match_method").count().collect()
    assert {r.match_method: r["count"] for r in found} == {
        "doc_match": 1,
        "email_to_doc_match": 1000,
        "singleton": 2000,
    }


def sample(spark):
    """Clusters of all kinds, one of them large."""
    rows = [
        {"cpf_cnpj": DOC1, "fonte": "empresa_a", "tipo_pessoa": "PF", "nome_razao_social": "Ana", "email": "b@x.y"},
        {"cpf_cnpj": DOC1, "fonte": "empresa_e", "tipo_pessoa": "PJ", "nome_razao_social": "Ana Sá", "email": "a@x.y"},
        {"fonte": "empresa_b", "tipo_pessoa": None, "nome_razao_social": "Zoé Sá", "email": "a@x.y", "telefone_principal": "+1"},
        {"cpf_cnpj": DOC1, "fonte": "empresa_a", "cidade": "Belém", "tipo_pessoa": None, "id_origem": "a-first"},
        {"nome_razao_social": None, "tipo_pessoa": None},
        {"id_unicad": None, "id_origem": None, "fonte": "empresa_d", "cidade": "C", "uf": "SP"},
        {"id_unicad": None, "id_origem": None, "fonte": "empresa_d", "telefone_principal": "+2"},
    ]
    rows += [
        {"cpf_cnpj": DOC2, "fonte": "empresa_d", "id_origem": DOC2, "email": f"m{i % 40}@x.y", "uf": "RO", "atributos_extras": f"{i % 90}"}
        for i in range(300)
    ]
    return resolve_entities(silver(spark, *rows))


def test_golden_values(spark):
    golden = build_golden(sample(spark), RUN_TS)
    assert [(f.name, f.dataType) for f in golden.schema] == [(f.name, f.dataType) for f in GOLDEN]
    rows = {r.cluster_key: r for r in golden.collect()}
    ana = rows["doc:" + DOC1]
    assert (ana.tipo_pessoa, ana.nome_razao_social) == ("PF", "Zoé Sá")
    assert (ana.cpf_cnpj, ana.cpf_cnpj_kind) == (DOC1, "CPF")
    assert (ana.emails, ana.telefones) == (["a@x.y", "b@x.y"], ["+1"])
    assert [tuple(e) for e in ana.enderecos] == [("Belém", None, "empresa_a")]
    assert (ana.fontes, ana.total_fontes) == (["empresa_a", "empresa_b", "empresa_e"], 3)
    assert ana.metodos_match == ["doc_match", "email_to_doc_match"]
    assert ana.ids_origem == {"empresa_a": "a-first", "empresa_b": "o2", "empresa_e": "o1"}
    assert len(ana.atributos_por_fonte) == 4
    assert ana.score_completude == 1.0
    lone = rows["lone:u4"]
    assert (lone.nome_razao_social, lone.tipo_pessoa, lone.emails, lone.enderecos) == (None, None, None, None)
    assert lone.score_completude == 0.125
    nobody = rows[None]
    assert (nobody.id_golden, nobody.ids_origem, nobody.total_fontes) == (None, {"empresa_d": None}, 1)
    assert (nobody.score_completude, len(nobody.atributos_por_fonte)) == (0.625, 2)


@pytest.mark.parametrize("records", [8, 50_000])
def test_lists_are_complete_at_every_size(spark, records):
    """One placeholder document on many records: same columns filled, nothing left out."""
    rows = spark.range(records).select(
        F.concat(F.lit("u"), "id").alias("id_unicad"),
        F.concat(F.lit("m"), F.col("id") % 7, F.lit("@x.y")).alias("email"),
        F.concat(F.lit("{"), F.col("id") % 3, F.lit("}")).alias("atributos_extras"),
        F.col("id").cast("string").alias("telefone_principal"),
    )
    base = silver(spark, {"cpf_cnpj": DOC1, "uf": "SP"}).drop(*rows.columns)
    golden = build_golden(resolve_entities(rows.crossJoin(base)), RUN_TS)
    row = golden.first()
    assert golden.count() == 1
    assert (len(row.emails), len(row.telefones), len(row.atributos_por_fonte)) == (7, records, records)
    assert row.emails == sorted(row.emails) and len(row.enderecos) == 1
    first = sum(e.atributos == "{0}" for e in row.atributos_por_fonte)
    assert first == -(-records // 3)
    # the plain text of a user finds it
    golden.createOrReplaceTempView("g")
    sql = "select e.uf, count(distinct id_golden) n from g lateral view explode(enderecos) t as e group by 1"
    assert [tuple(r) for r in spark.sql(sql).collect()] == [("SP", 1)]


def test_list_entries_and_rows(spark):
    clustered = sample(spark)
    golden = build_golden(clustered, RUN_TS)
    entries = list_entries(clustered)
    assert entries.where("lista = 'emails'").count() == list_rows(golden, "emails").count()
    assert entries.where("lista = 'enderecos'").count() == list_rows(golden, "enderecos").count()
    attributes = entries.where("lista = 'atributos_por_fonte'").agg(F.sum("registros")).first()[0]
    assert attributes == list_rows(golden, "atributos_por_fonte").count() == clustered.count()


def test_gold_does_not_depend_on_the_layout(spark):
    clustered = sample(spark)
    one = as_set(build_golden(clustered.repartition(1), RUN_TS))
    many = as_set(build_golden(clustered.repartition(17), RUN_TS))
    assert one == many


def test_id_conflicts(spark):
    clustered = sample(spark)
    found = id_conflicts(clustered).collect()
    assert [(r.cluster_key, r.fonte, r.ids, r.id_mantido) for r in found] == [("doc:" + DOC1, "empresa_a", 2, "a-first")]
    with pytest.raises(FAILED_QUERY, match="several source ids"):
        build_golden(clustered, RUN_TS, strict=True).collect()
    clean = clustered.where(F.col("id_origem").isNull() | (F.col("id_origem") != "a-first"))
    assert build_golden(clean, RUN_TS, strict=True).count() == 4


def test_counted_attributes_are_as_complete_and_never_repeated(spark):
    clustered = sample(spark)
    counted = build_golden(clustered, RUN_TS, counted=True)
    entries = counted.select("cluster_key", F.explode("atributos_por_fonte").alias("e")).select("cluster_key", "e.*")
    assert entries.columns == ["cluster_key", "fonte", "atributos", "registros"]
    found = {(r.cluster_key, r.fonte, r.atributos): r.registros for r in entries.collect()}
    rows = clustered.groupBy("cluster_key", "fonte", "atributos_extras").count().collect()
    assert found == {(r["cluster_key"], r["fonte"], r["atributos_extras"]): r["count"] for r in rows}
    whole = build_golden(clustered, RUN_TS)
    assert as_set(counted.drop("atributos_por_fonte")) == as_set(whole.drop("atributos_por_fonte"))
    assert max(found.values()) > 1


def test_the_hot_cluster_has_no_entry_per_record_in_its_row(spark):
    hot = queries.golden_hot(spark, "/root/testdata/sf0.001")
    plan = hot._jdf.queryExecution().optimizedPlan().toString()
    # its lists are read as the aggregate leaves them: only ids and totals are worked out behind it
    assert "array_repeat" not in plan and "flatten" not in plan
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert hot.agg(F.sum("atributos")).first()[0] == lines.count()
    assert hot.agg(F.sum("soma")).first()[0] == lines.agg(F.sum(F.col("l_quantity").cast("int"))).first()[0]


@pytest.mark.parametrize("limit", [0, 1, 3, 1_000])
def test_records_do_not_depend_on_how_a_cluster_is_gathered(spark, monkeypatch, limit):
    monkeypatch.setattr(golden_operators, "SMALL", limit)
    clustered = sample(spark).persist()
    assert as_set(build_golden_by_size(clustered, RUN_TS)) == as_set(build_golden(clustered, RUN_TS))
    with pytest.raises(FAILED_QUERY, match="several source ids"):
        build_golden_by_size(clustered, RUN_TS, strict=True).collect()


def test_records_of_small_clusters_are_shuffled_once(spark):
    clustered = stage(sample(spark), "by-size")
    plan = build_golden_by_size(clustered, RUN_TS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
