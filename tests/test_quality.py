"""Checks, freshness, anomalies, schema changes and the report."""

import os
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenrec.operators import metrics
from goldenrec.operators import quality as Q
from goldenrec.operators.golden import build_golden
from goldenrec.operators.resolve import resolve_entities
from goldenrec.sources.readers import list_objects
from helpers import RUN_TS, silver

NOW = datetime(2024, 1, 3, tzinfo=UTC)


def test_the_contract_has_45_checks():
    assert len(Q.CONTRACT) == 45
    assert len({(c.name, c.where) for c in Q.CONTRACT}) == 45


def test_rules(spark):
    frame = spark.createDataFrame([("a", 1), ("a", None), (None, 1), (None, 2), ("b", 3)], "k string, n int")
    checks = [
        Q.Check("t", "k", "not_null"),
        Q.Check("t", "k", "unique"),
        Q.Check("t", "n", "unique"),
        Q.Check("t", "k", "accepted_values", ("a",)),
        Q.Check("t", "k", "accepted_values", ("a",), where="n = 1"),
        Q.Check("t", "k", "unique", where="n = 3"),
    ]
    found = [(r.regra, r.coluna, r.falhas, r.status) for r in Q.run_checks(frame, checks).collect()]
    assert sorted(found) == sorted(
        [
            ("not_null", "k", 2, "fail"),
            ("accepted_values", "k", 1, "fail"),
            ("accepted_values", "k", 0, "pass"),
            ("unique", "k", 1, "fail"),
            ("unique", "n", 1, "fail"),
            ("unique", "k", 0, "pass"),
        ]
    )


def _loaded(spark, *instants):
    return spark.createDataFrame([(i,) for i in instants], "_ingested_at string")


def test_freshness(spark):
    sources = {
        "new": _loaded(spark, "2024-01-02T13:00:00+00:00", "2023-01-01T00:00:00+00:00"),
        "late": _loaded(spark, "2024-01-02T08:00:00.5-03:00"),
        "old": _loaded(spark, "2024-01-01T11:59:59+00:00"),
        "empty": _loaded(spark),
        "edge": _loaded(spark, "2024-01-02T12:00:00+00:00"),
    }
    report = Q.freshness(sources, NOW)
    assert {r.unique_id: r.status for r in report.collect()} == {
        "new": "pass", "late": "warn", "old": "error", "empty": "error", "edge": "pass"
    }
    again = report.withColumn("generated_at", F.col("generated_at") - F.expr("interval 1 day")).withColumn(
        "status", F.lit("runtime_error")
    )
    history = again.unionByName(report)
    assert tuple(Q.freshness_rollup(history).first()) == (2, 1, 2, "error")
    ok = report.where("unique_id in ('new', 'edge')")
    assert tuple(Q.freshness_rollup(ok).first()) == (2, 0, 0, "ok")
    assert Q.freshness_rollup(report.limit(0)).first().status == "warn"
    assert Q.freshness_check(report.limit(0))[0] == "warn"
    assert Q.freshness_check(history)[:2] == ("error", "2 pass, 1 warn, 2 error")


def _runs(spark, counts, **more):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(days=i), n, more.get("tabela", "t")) for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, "run_ts timestamp_ntz, registros long, tabela string")


def test_volume_anomalies(spark):
    steady = [100, 101, 99, 100, 102, 98, 100, 101]
    found = Q.anomalies(_runs(spark, [*steady, 300])).orderBy("run_ts").collect()
    assert [r.anomalia for r in found] == [False] * 8 + [True]
    assert found[6].z is None and found[7].z is not None
    young = Q.anomalies(_runs(spark, [100, 101, 99, 100, 102, 98, 900])).collect()
    assert not any(r.anomalia for r in young)
    flat = Q.anomalies(_runs(spark, [5] * 10 + [900])).orderBy("run_ts").collect()
    assert not flat[-1].anomalia and flat[-1].z is None


def test_only_the_last_runs_count(spark):
    counts = [10_000] * 5 + [100 + i % 3 for i in range(14)] + [160]
    assert Q.anomalies(_runs(spark, counts)).orderBy(F.desc("run_ts")).first().anomalia


def test_dimensions_are_judged_apart(spark):
    a = _runs(spark, [100 + i % 2 for i in range(9)] + [500], tabela="a")
    b = _runs(spark, [500 + i % 2 for i in range(10)], tabela="b")
    found = Q.anomalies(a.unionByName(b)).where("anomalia").collect()
    assert [(r.tabela, r.registros) for r in found] == [("a", 500)]


def test_run_counts(spark):
    frame = silver(spark, {}, {}, {"fonte": "empresa_b"})
    total = Q.count_run(frame, "t", RUN_TS).first()
    assert (total.registros, total.tabela) == (3, "t")
    by = {r.fonte: r.registros for r in Q.count_run(frame, "t", RUN_TS, "fonte").collect()}
    assert by == {"empresa_a": 2, "empresa_b": 1}


def test_schema_changes(spark):
    before = T.StructType.fromDDL("a int, b string, c array<string>")
    after = T.StructType.fromDDL("a long, c array<string>, d map<string,string>")
    found = {tuple(r) for r in Q.schema_changes(spark, before, after).collect()}
    assert found == {
        ("a", "type_changed", "int", "bigint"),
        ("b", "removed", "string", None),
        ("d", "added", None, "map<string,string>"),
    }
    assert Q.schema_changes(spark, before, before).isEmpty()


def test_report_isolates_failures(spark, tmp_path):
    held = tmp_path / "_quarantine" / "x.parquet"
    held.parent.mkdir()
    held.write_text("not parquet")
    os.utime(held, (NOW.timestamp() - 40 * 3600,) * 2)
    files = list_objects(spark, str(held.parent))

    def broken():
        raise RuntimeError("boom")

    report = Q.check_report(
        spark,
        [
            ("quarantine", "Pipeline", lambda: Q.quarantine_check(files)),
            ("no quarantine", "Pipeline", lambda: Q.quarantine_check(files.limit(0))),
            ("age", "Pipeline", lambda: Q.age_check(files, NOW)),
            ("recent", "Pipeline", lambda: Q.age_check(files, NOW - timedelta(hours=30))),
            ("missing", "Pipeline", lambda: Q.age_check(list_objects(spark, f"{tmp_path}/none"), NOW)),
            ("broken", "Pipeline", broken),
        ],
        NOW,
    )
    assert {r.name: r.status for r in report.collect()} == {
        "quarantine": "warn",
        "no quarantine": "ok",
        "age": "warn",
        "recent": "ok",
        "missing": "warn",
        "broken": "unknown",
    }
    assert {r.status: r.verificacoes for r in Q.report_counts(report).collect()} == {"ok": 2, "warn": 3, "unknown": 1}


def test_metrics(spark):
    customers = silver(
        spark,
        {"cpf_cnpj": "26542351140", "email": "a@x.y", "cidade": "C"},
        {"fonte": "empresa_b", "email": "a@x.y", "cpf_cnpj_valido": False},
        {"fonte": "empresa_b", "cpf_cnpj_valido": False},
    )
    nothing = customers.limit(0)
    golden = build_golden(resolve_entities(customers), RUN_TS)
    empty = golden.limit(0)
    table = metrics.quality_metrics(customers, nothing, golden, empty)
    rows = [r.asDict() for r in table.collect()]
    assert [(r["tipo_cadastro"], r["fonte"]) for r in rows] == [
        ("clientes", "_TOTAL"),
        ("clientes", "empresa_a"),
        ("clientes", "empresa_b"),
    ]
    total, a, b = rows
    assert (total["registros_prata"], total["registros_ouro"], total["registros_multi_fonte"]) == (3, 2, 1)
    assert total["taxa_deduplicacao"] == pytest.approx(0.333)
    assert total["com_email"] is None and a["registros_ouro"] is None
    assert (b["com_doc_valido"], b["pct_email"], b["pct_cidade"], a["pct_doc_valido"]) == (0, 0.5, 0.0, 1.0)
    assert {r.total_fontes: r.entidades for r in metrics.overlap_histogram(golden).collect()} == {1: 1, 2: 1}


def test_schema_drift_by_run(spark):
    day = [datetime(2024, 1, d, tzinfo=UTC) for d in range(1, 5)]
    versions = ["a int, b string", "a int, b string", "a bigint, c array<int>", "a bigint, b string, c array<int>"]
    runs = [Q.schema_run(spark.createDataFrame([], v), "t", d) for v, d in zip(versions, day)]
    runs += [runs[2], Q.schema_run(spark.range(3), "u", day[1])]
    history = runs[0]
    for run in runs[1:]:
        history = history.unionByName(run)
    found = {tuple(r) for r in Q.schema_drift(history).select(F.dayofmonth("run_ts"), "tabela", "coluna", "mudanca", "antes", "depois", "registros").collect()}
    assert found == {
        (3, "t", "a", "type_changed", "int", "bigint", 0),
        (3, "t", "b", "removed", "string", None, 0),
        (3, "t", "c", "added", None, "array<int>", 0),
        (4, "t", "b", "added", None, "string", 0),
    }
    assert Q.schema_drift(history.where("false")).isEmpty()
