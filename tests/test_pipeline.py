"""From source files to gold: planned overlaps, repeated ingestion, checks and SQL views."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from goldenrec.operators import lineage, search
from goldenrec.operators.quality import CONTRACT
from goldenrec.plans import catalog, versions
from goldenrec.plans.pipeline import run_pipeline
from goldenrec.sources import bronze as B
from goldenrec.schemas import BRONZE
from fixtures import Universe
from goldenrec.sources.readers import read_bronze
from helpers import RUN_TS, as_set

FIRST, SECOND = (datetime(2024, month, 3, tzinfo=UTC) for month in (1, 2))


def land(spark, folder):
    """Source files of one fixture universe: NDJSON, CSV and page files; tables stay frames."""
    world = Universe(spark)
    world.documents().coalesce(1).write.text(f"{folder}/docs")
    for kind in ("clientes", "fornecedores"):
        world.spreadsheet(kind).coalesce(1).write.option("header", True).option("escape", '"').option(
            "quoteAll", True
        ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(
            f"{folder}/sheets/{kind}.csv"
        )
    records = [json.loads(r[0]) for r in world.api().select(F.to_json(F.struct("*"))).collect()]
    (folder / "pages").mkdir()
    for start in range(0, len(records), 25):
        page = {
            "page": start // 25 + 1,
            "per_page": 25,
            "total": len(records),
            "has_next": start + 25 < len(records),
            "data": records[start : start + 25],
        }
        (folder / "pages" / f"{start}.json").write_text(json.dumps(page, ensure_ascii=False), encoding="utf-8")
    return {
        "empresa_a": {kind: world.relational(kind) for kind in ("clientes", "fornecedores")},
        "empresa_b": {"clientes": world.crm()},
        "empresa_c": B.extract_c(spark, f"{folder}/docs"),
        "empresa_d": B.extract_d(spark, f"{folder}/sheets"),
        "empresa_e": B.extract_e(spark, f"{folder}/pages"),
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """A lake after two ingestions of the same sources."""
    base = tmp_path_factory.mktemp("lake")
    sources = land(spark, tmp_path_factory.mktemp("landing"))
    B.ingest_all(sources, f"{base}/bronze", FIRST)
    once = run_pipeline(spark, str(base), RUN_TS)
    before = {name: as_set(once.tables[name], *TIMES) for name in ("golden_clientes", "golden_fornecedores")}
    B.ingest_all(sources, f"{base}/bronze", SECOND)
    return str(base), run_pipeline(spark, str(base), RUN_TS), before


TIMES = ("primeira_aparicao", "ultima_atualizacao")


def test_planned_overlaps(lake):
    tables = lake[1].tables
    assert tables["int_clientes_padronizados"].count() == 310
    assert tables["int_fornecedores_padronizados"].count() == 175

    def histogram(name):
        return {r.total_fontes: r["count"] for r in tables[name].groupBy("total_fontes").count().collect()}

    assert histogram("golden_clientes") == {1: 225, 2: 5, 3: 5, 4: 15}
    assert histogram("golden_fornecedores") == {1: 130, 2: 15, 3: 5}


def test_repeated_ingestion_changes_nothing_but_the_times(lake):
    _, after, before = lake
    for name, rows in before.items():
        assert as_set(after.tables[name], *TIMES) == rows
    stamps = after.tables["golden_clientes"].agg(F.max("ultima_atualizacao")).first()[0]
    assert stamps.startswith("2024-02-03")
    assert after.tables["empresa_b_clientes"].count() == 200


def test_all_45_checks_pass(lake):
    report = lake[1].checks.collect()
    assert len(report) == len(CONTRACT) == 45
    assert [r for r in report if r.status != "pass"] == []


def test_metrics_match_the_plan(lake):
    rows = {(r.tipo_cadastro, r.fonte): r for r in lake[1].tables["metricas_qualidade"].collect()}
    assert len(rows) == 9
    assert rows["clientes", "_TOTAL"].taxa_deduplicacao == 0.194
    assert rows["fornecedores", "_TOTAL"].taxa_deduplicacao == 0.143
    assert {f: rows["clientes", f].pct_doc_valido for f in ("empresa_a", "empresa_b", "empresa_d", "empresa_e")} == {
        "empresa_a": 1.0,
        "empresa_b": 0.0,
        "empresa_d": 1.0,
        "empresa_e": 1.0,
    }
    assert [rows["clientes", f].registros_prata for f in ("empresa_a", "empresa_b", "empresa_d", "empresa_e")] == [60, 100, 50, 100]


def test_companies_in_both_registries(lake):
    tables = lake[1].tables
    both = tables["golden_clientes"].select("id_golden").intersect(tables["golden_fornecedores"].select("id_golden"))
    assert both.count() == 20


def test_match_methods(lake):
    found = lake[1].tables["int_clientes_cluster"].groupBy("fonte", "match_method").count().collect()
    assert {(r.fonte, r.match_method): r["count"] for r in found} == {
        ("empresa_a", "doc_match"): 60,
        ("empresa_b", "email_to_doc_match"): 25,
        ("empresa_b", "singleton"): 75,
        ("empresa_d", "doc_match"): 50,
        ("empresa_e", "doc_match"): 100,
    }


def test_lineage_and_source_rows(lake):
    tables = lake[1].tables
    golden, clustered = tables["golden_clientes"], tables["int_clientes_cluster"]
    chosen = golden.where("total_fontes = 4").orderBy("id_golden").first()
    rows = lineage.lineage(golden, clustered, chosen.id_golden).collect()
    assert {r.fonte: r.id_origem for r in rows} == chosen.ids_origem and len(rows) == 4
    bronze = {
        "empresa_a": (tables["empresa_a_clientes"], F.col("id").cast("string")),
        "empresa_b": (tables["empresa_b_clientes"], F.col("client_id").cast("string")),
    }
    one = golden.where(F.col("id_golden") == chosen.id_golden)
    found = lineage.source_records(one, bronze).collect()
    assert sorted(lineage.source_records(one, bronze, few=True).collect()) == sorted(found)
    assert {r.fonte for r in found} == {"empresa_a", "empresa_b"}
    assert all(json.loads(r.registro)["_ingested_at"].startswith("2024-02") for r in found)


def test_views_and_sql(spark, lake, tmp_path, capsys):
    base = lake[0]
    views = catalog.register_views(spark, base)
    assert len(views) == 15
    row = catalog.run_sql(
        spark,
        "SELECT count(*) AS n, count(*) FILTER (WHERE total_fontes > 1) AS shared FROM golden_clientes;",
    ).first()
    assert tuple(row) == (250, 25)
    by_uf = catalog.run_sql(
        spark,
        "SELECT e.uf, count(DISTINCT id_golden) AS clientes FROM golden_clientes "
        "LATERAL VIEW explode(enderecos) t AS e GROUP BY e.uf ORDER BY clientes DESC, e.uf LIMIT 5",
    ).collect()
    same = lineage.entities_per_uf(
        lake[1].tables["golden_clientes"].select("id_golden", F.inline("enderecos"))
    ).orderBy(F.desc("clientes"), "uf")
    assert by_uf == same.limit(5).collect()
    assert catalog.run_sql(spark, "SELECT count(*) FROM bronze_all").first()[0] == 2 * (60 + 20 + 100 + 100 + 100) + (
        spark.table("bronze_all").where("_source = 'empresa_d'").count()
    )
    script = tmp_path / "q.sql"
    script.write_text("SELECT clean_doc('1-2') AS d")
    assert catalog.run_sql_file(spark, str(script)).first().d == "12"
    assert catalog.run_sql(spark, "SELEC 1") is None
    assert "Error" in capsys.readouterr().err


def test_search_on_stored_gold(spark, lake):
    golden = versions.read(spark, f"{lake[0]}/ouro/golden_clientes.parquet")
    page = search.search(golden, q="a", per_page=100)
    assert page.total >= len(page.data.collect()) == min(page.total, 100)


def test_batches_with_more_columns(spark, tmp_path):
    crm = Universe(spark).crm()
    B.ingest({"clientes": crm}, "empresa_b", str(tmp_path), B.Batch.new(FIRST))
    B.ingest({"clientes": crm.withColumn("novo", F.lit("x"))}, "empresa_b", str(tmp_path), B.Batch.new(SECOND))
    contract = read_bronze(spark, str(tmp_path), "empresa_b", "clientes")
    assert contract.columns == BRONZE["empresa_b", "clientes"].names and contract.count() == 200
    whole = read_bronze(spark, str(tmp_path), "empresa_b", "clientes", every_column=True)
    assert set(whole.columns) == {*contract.columns, "novo"}
    assert whole.where("novo = 'x'").count() == whole.where("novo is null").count() == 100


def test_lake_with_one_source_only(spark, tmp_path):
    """What the README example does on a fresh lake: the other six registries have no folder."""
    base = str(tmp_path / "lake")
    nobody = spark.createDataFrame([], "client_id long")
    sources = {"empresa_a": {"clientes": Universe(spark).relational("clientes")}, "empresa_b": {"clientes": nobody}}
    B.ingest_all(sources, f"{base}/bronze", FIRST)
    tables = run_pipeline(spark, base, RUN_TS).tables
    assert tables["golden_clientes"].count() > 0 and tables["golden_fornecedores"].count() == 0
    assert tables["stg_empresa_e_clientes"].count() == 0
    assert "bronze_all" in catalog.register_views(spark, base)
    assert run_pipeline(spark, base, RUN_TS, since=(FIRST.year + 1, 1)).tables["golden_clientes"].count() == 0
