"""Run history and the operational report of a lake."""

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from goldenrec.operators.standardize import SPECS
from goldenrec.plans import monitor
from helpers import silver

START = datetime(2024, 1, 1, 6, tzinfo=UTC)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Nine quiet runs, then one in which a source doubles; the last run is recorded twice."""
    folder = str(tmp_path_factory.mktemp("monitored"))
    row = silver(spark, {}).withColumn("n", F.lit(1))

    def rows(count, fonte="empresa_a"):
        many = row.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(count))))
        return many.withColumn("fonte", F.lit(fonte))

    for day in [*range(10), 9]:
        at = START + timedelta(days=day)
        bronze = spark.createDataFrame([((at - timedelta(hours=1)).isoformat(),)], "_ingested_at string")
        old = spark.createDataFrame([((at - timedelta(hours=20)).isoformat(),)], "_ingested_at string")
        tables = {f"{source}_{kind}": bronze for source, kind in SPECS}
        tables["empresa_e_clientes"] = old
        extra = 60 if day == 9 else day % 2
        tables["int_clientes_padronizados"] = rows(50 + extra).unionByName(rows(500, "empresa_b"))
        tables["int_fornecedores_padronizados"] = rows(40 + day % 3)
        tables["golden_clientes"] = row.select("fonte", *(["uf"] if day == 9 else ["cidade"]))
        monitor.record_run(tables, folder, at)
    return folder


def test_history_has_one_entry_per_run(spark, base):
    assert monitor.history(spark, base, monitor.VOLUME).count() == 20
    assert monitor.history(spark, base, monitor.DIMENSION).count() == 20
    assert monitor.history(spark, base, monitor.FRESHNESS).count() == 70


def test_the_unusual_source_is_found(spark, base):
    found = monitor.dimension_anomalies(spark, base).where("anomalia").collect()
    assert [(r.fonte, r.registros) for r in found] == [("empresa_a", 110)]
    found = monitor.volume_anomalies(spark, base).where("anomalia").collect()
    assert [(r.tabela, r.registros) for r in found] == [("int_clientes_padronizados", 610)]


def test_schema_changes_by_run(spark, base):
    found = monitor.schema_changes(spark, base).collect()
    assert {(r.coluna, r.mudanca, r.registros) for r in found} == {("cidade", "removed", 1), ("uf", "added", 1)}


def test_report(spark, base):
    rows = {r.name: (r.status, r.detail) for r in monitor.report(spark, base, START).collect()}
    assert rows["freshness"] == ("warn", "6 pass, 1 warn, 0 error")
    assert rows["volume"] == ("warn", "1 unusual counts")
    assert rows["sources"] == ("warn", "1 unusual counts")
    assert rows["schema"] == ("warn", "golden_clientes.cidade removed, golden_clientes.uf added")
    assert rows["quarantine"][0] == "ok"
    assert rows["metrics age"] == ("warn", "not written yet")
    nothing = {r.name: r.status for r in monitor.report(spark, base + "/none", START).collect()}
    assert nothing["volume"] == "unknown" and nothing["quarantine"] == "ok"
