"""Run history of a lake, and the operational report over it."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenrec.operators import quality
from goldenrec.operators.standardize import SPECS
from goldenrec.plans.pipeline import REGISTRIES, model_path, union_model
from goldenrec.sources.readers import list_objects

VOLUME, DIMENSION, FRESHNESS, SCHEMA = "volume", "fonte", "freshness", "schema"


def _folder(base: str, kind: str) -> str:
    return f"{base.rstrip('/')}/historico/{kind}"


def _record(rows: DataFrame, base: str, kind: str, run_ts: datetime) -> None:
    """One folder per run: a repeated run replaces its own entry, other runs are never touched."""
    rows.coalesce(1).write.mode("overwrite").parquet(f"{_folder(base, kind)}/{run_ts:%Y%m%dT%H%M%S}.parquet")


def record_run(tables: dict[str, DataFrame], base: str, run_ts: datetime) -> None:
    """Append row counts of both silver unions, customers per source, the sources' freshness and the golden columns."""
    customers, suppliers = (union_model(registry) for registry in REGISTRIES)
    volumes = quality.count_run(tables[customers], customers, run_ts).unionByName(
        quality.count_run(tables[suppliers], suppliers, run_ts)
    )
    _record(volumes, base, VOLUME, run_ts)
    _record(quality.count_run(tables[customers], customers, run_ts, "fonte"), base, DIMENSION, run_ts)
    sources = {f"{source}_{kind}": tables[f"{source}_{kind}"] for source, kind in SPECS}
    _record(quality.freshness(sources, run_ts), base, FRESHNESS, run_ts)
    golden = [name for name in (f"golden_{registry}" for registry in REGISTRIES) if name in tables]
    columns = [quality.schema_run(tables[name], name, run_ts) for name in golden]
    if columns:
        _record(reduce(DataFrame.unionByName, columns), base, SCHEMA, run_ts)


def history(spark: SparkSession, base: str, kind: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).parquet(_folder(base, kind))


def volume_anomalies(spark: SparkSession, base: str) -> DataFrame:
    return quality.anomalies(history(spark, base, VOLUME))


def dimension_anomalies(spark: SparkSession, base: str) -> DataFrame:
    return quality.anomalies(history(spark, base, DIMENSION), ("tabela", "fonte"))


def schema_changes(spark: SparkSession, base: str) -> DataFrame:
    return quality.schema_drift(history(spark, base, SCHEMA))


def _latest_schema(recorded: DataFrame) -> quality.Outcome:
    """Verdict on the newest run against the one before it."""
    newest = recorded.agg(F.max("run_ts")).first()[0]
    found = quality.schema_drift(recorded).where(F.col("run_ts") == newest).orderBy("tabela", "coluna").collect()
    if not found:
        return "ok", "columns as before", ""
    told = ", ".join(f"{row.tabela}.{row.coluna} {row.mudanca}" for row in found)
    return "warn", told, "tell the readers of these tables"


def _latest_anomalies(scored: DataFrame) -> quality.Outcome:
    """Verdict on the newest run only; earlier anomalies were reported in their time."""
    newest = scored.agg(F.max("run_ts")).first()[0]
    found = scored.where((F.col("run_ts") == newest) & F.col("anomalia")).count()
    if found == 0:
        return "ok", "counts as usual", ""
    return "warn", f"{found} unusual counts", "compare the newest batches with the ones before"


def report(spark: SparkSession, base: str, now: datetime) -> DataFrame:
    """The table checks of a lake as one report; a check that cannot run is ``unknown``."""
    root = base.rstrip("/")
    metrics = model_path(base, "metricas_qualidade")
    return quality.check_report(
        spark,
        [
            ("freshness", "Pipeline", lambda: quality.freshness_check(history(spark, base, FRESHNESS))),
            ("volume", "Pipeline", lambda: _latest_anomalies(volume_anomalies(spark, base))),
            ("sources", "Pipeline", lambda: _latest_anomalies(dimension_anomalies(spark, base))),
            ("schema", "Pipeline", lambda: _latest_schema(history(spark, base, SCHEMA))),
            (
                "quarantine",
                "Pipeline",
                lambda: quality.quarantine_check(list_objects(spark, f"{root}/bronze/_quarantine")),
            ),
            ("metrics age", "Pipeline", lambda: quality.age_check(list_objects(spark, metrics, "*.parquet"), now)),
        ],
        now,
    )
