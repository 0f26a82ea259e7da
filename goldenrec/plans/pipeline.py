"""Bronze -> silver -> gold -> checks, with every layer stored as Parquet."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from goldenrec.operators.golden import build_golden
from goldenrec.operators.metrics import quality_metrics
from goldenrec.operators.quality import run_contract
from goldenrec.operators.resolve import resolve_entities
from goldenrec.operators.standardize import SPECS, standardize, union_registry
from goldenrec.plans import versions
from goldenrec.session import concurrently
from goldenrec.sources.readers import empty_bronze, read_bronze

REGISTRIES = ("clientes", "fornecedores")


def union_model(registry: str) -> str:
    return f"int_{registry}_padronizados"


SILVER_MODELS = (*(spec.model for spec in SPECS.values()), *(union_model(r) for r in REGISTRIES))
GOLD_MODELS = (
    "int_clientes_cluster",
    "int_fornecedores_cluster",
    "golden_clientes",
    "golden_fornecedores",
    "metricas_qualidade",
)


class Lake(NamedTuple):
    """Tables of one run by model name, and the result of the data checks."""

    tables: dict[str, DataFrame]
    checks: DataFrame


def staging_union(tables: dict[str, DataFrame], registry: str) -> DataFrame:
    """Silver of one registry: a view over its stored staging tables, not a second copy of them."""
    models = [spec.model for spec in SPECS.values() if spec.registry == registry]
    return union_registry([tables[model] for model in models if model in tables])


def layer_of(model: str) -> str:
    return "ouro" if model in GOLD_MODELS else "prata"


def model_path(base: str, model: str) -> str:
    return f"{base.rstrip('/')}/{layer_of(model)}/{model}.parquet"


def write_model(frame: DataFrame, base: str, model: str) -> DataFrame:
    """Replace one stored table in one step and return it as read back.

    Golden files are sorted by id inside each task and carry bloom filters on the two lookup
    columns: a point read skips nearly all row groups, and no shuffle is spent on the layout.
    """
    writer_options = {}
    if model in ("golden_clientes", "golden_fornecedores"):
        frame = frame.sortWithinPartitions("id_golden")
        writer_options = {f"parquet.bloom.filter.enabled#{name}": "true" for name in ("id_golden", "cpf_cnpj")}
    return versions.replace(frame, model_path(base, model), **writer_options)


def read_all_bronze(spark: SparkSession, base: str, **options: object) -> dict[tuple[str, str], DataFrame]:
    return {key: read_bronze(spark, f"{base.rstrip('/')}/bronze", *key, **options) for key in SPECS}


def build_lake(
    bronze: dict[tuple[str, str], DataFrame],
    base: str,
    run_ts: datetime | None = None,
    *,
    strict: bool = False,
) -> Lake:
    """Silver and gold from bronze tables, stored below ``base``, then the data checks.

    Each step reads the stored step before it, so nothing upstream is computed twice and a lost
    executor costs only the running step. Independent steps run side by side. Sources that are not given
    are empty ones: their tables exist without rows.
    """
    run_ts = run_ts or datetime.now(UTC)
    spark = next(iter(bronze.values())).sparkSession
    bronze = {key: bronze[key] if key in bronze else empty_bronze(spark, *key) for key in SPECS}
    tables: dict[str, DataFrame] = {
        f"{source}_{registry}": frame for (source, registry), frame in bronze.items()
    }

    def store(model: str, frame: DataFrame) -> DataFrame:
        tables[model] = write_model(frame, base, model)
        return tables[model]

    def stored_staging(key: tuple[str, str]) -> DataFrame:
        return store(SPECS[key].model, standardize(bronze[key], SPECS[key], run_ts, strict))

    def stored_gold(registry: str) -> None:
        silver = staging_union(tables, registry)
        tables[union_model(registry)] = silver
        clustered = store(f"int_{registry}_cluster", resolve_entities(silver))
        store(f"golden_{registry}", build_golden(clustered, run_ts, strict=strict))

    concurrently([partial(stored_staging, key) for key in SPECS])
    concurrently([partial(stored_gold, registry) for registry in REGISTRIES])
    store(
        "metricas_qualidade",
        quality_metrics(
            tables["int_clientes_padronizados"],
            tables["int_fornecedores_padronizados"],
            tables["golden_clientes"],
            tables["golden_fornecedores"],
        ),
    )
    return Lake(tables, run_contract(tables))


def run_pipeline(
    spark: SparkSession,
    base: str,
    run_ts: datetime | None = None,
    *,
    since: tuple[int, int] | None = None,
    **options: object,
) -> Lake:
    """Rebuild silver and gold of a lake from what its bronze folder holds.

    ``since=(year, month)`` leaves the folders of earlier months unread: right when every source delivers
    its whole registry at least once from then on.
    """
    return build_lake(read_all_bronze(spark, base, since=since), base, run_ts, **options)


def open_lake(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The silver and gold tables by name."""
    names = [spec.model for spec in SPECS.values()] + list(GOLD_MODELS)
    tables = {name: versions.read(spark, model_path(base, name)) for name in names}
    unions = {union_model(registry): staging_union(tables, registry) for registry in REGISTRIES}
    return {name: {**tables, **unions}[name] for name in SILVER_MODELS + GOLD_MODELS}
