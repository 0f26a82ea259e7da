"""Quality metrics of silver and gold, side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.schemas import METRICS

TOTAL = "_TOTAL"
_FILLED = {
    "com_email": "email",
    "com_telefone": "telefone_principal",
    "com_cidade": "cidade",
    "com_uf": "uf",
}
_SHARES = {
    "pct_doc_valido": "com_doc_valido",
    "pct_email": "com_email",
    "pct_telefone": "com_telefone",
    "pct_cidade": "com_cidade",
}


def ratio(part: Column, whole: Column) -> Column:
    """Double ratio; NULL over zero."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def source_counts(silver: DataFrame, label: str) -> DataFrame:
    """Filled fields per source: one pass, combined before the shuffle, so a dominant source is fine."""
    filled = [F.count(column).alias(name) for name, column in _FILLED.items()]
    return (
        silver.groupBy("fonte")
        .agg(
            F.count(F.lit(1)).alias("registros_prata"),
            F.count_if("cpf_cnpj_valido").alias("com_doc_valido"),
            *filled,
        )
        .withColumn("tipo_cadastro", F.lit(label))
    )


def golden_totals(golden: DataFrame, label: str) -> DataFrame:
    """One row per registry, also when it is empty."""
    return golden.agg(
        F.count(F.lit(1)).alias("registros_ouro"),
        F.avg("score_completude").alias("score"),
        F.avg(F.col("total_fontes").cast("double")).alias("sources"),
        F.sum((F.col("total_fontes") > 1).cast("bigint")).alias("registros_multi_fonte"),
    ).withColumn("tipo_cadastro", F.lit(label))


def _metrics_layout(frame: DataFrame, **computed: Column) -> DataFrame:
    columns = []
    for field in METRICS:
        value = computed.get(field.name)
        if value is None:
            value = F.col(field.name) if field.name in frame.columns else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return frame.select(columns)


def quality_metrics(
    silver_c: DataFrame, silver_f: DataFrame, golden_c: DataFrame, golden_f: DataFrame
) -> DataFrame:
    """A row per (registry, source) and a ``_TOTAL`` row per registry that has silver rows."""
    counts = source_counts(silver_c, "clientes").unionByName(source_counts(silver_f, "fornecedores"))
    shares = {
        name: F.round(ratio(F.col(part), F.col("registros_prata")), 3)
        for name, part in _SHARES.items()
    }
    by_source = _metrics_layout(counts, **shares)

    silver_totals = counts.groupBy("tipo_cadastro").agg(F.sum("registros_prata").alias("registros_prata"))
    totals = golden_totals(golden_c, "clientes").unionByName(golden_totals(golden_f, "fornecedores"))
    # two registries, so two rows at most on either side
    joined = totals.join(F.broadcast(silver_totals), "tipo_cadastro")
    kept = ratio(F.col("registros_ouro"), F.col("registros_prata"))
    by_registry = _metrics_layout(
        joined,
        fonte=F.lit(TOTAL),
        score_completude_medio=F.round("score", 3),
        fontes_medias_por_registro=F.round("sources", 3),
        taxa_deduplicacao=F.round(F.lit(1.0) - kept, 3),
    )
    return by_source.unionByName(by_registry).orderBy("tipo_cadastro", "fonte")


def overlap_histogram(golden: DataFrame) -> DataFrame:
    """How many entities appear in 1, 2, 3, ... sources."""
    return golden.groupBy("total_fontes").agg(F.count(F.lit(1)).alias("entidades")).orderBy("total_fontes")
