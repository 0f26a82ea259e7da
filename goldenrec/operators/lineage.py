"""From golden records back to the source records, and the summary reports over gold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.operators.joins import shuffled_alone
from goldenrec.operators.latest import latest_per_key


def lineage(golden: DataFrame, clustered: DataFrame, id_golden: str | None = None) -> DataFrame:
    """Every silver record behind the golden records, or behind one of them."""
    chosen = golden if id_golden is None else golden.where(F.col("id_golden") == id_golden)
    heads = chosen.select("id_golden", "cluster_key", F.col("nome_razao_social").alias("golden"))
    return heads.join(clustered, "cluster_key").select(
        "id_golden",
        "golden",
        "fonte",
        "id_origem",
        F.col("nome_razao_social").alias("nome_na_fonte"),
        "email",
        "telefone_principal",
    )


def source_records(
    golden: DataFrame, bronze: Mapping[str, tuple[DataFrame, Column]], *, few: bool = False
) -> DataFrame:
    """Newest raw bronze row behind each entry of ``ids_origem``, as JSON text.

    ``bronze`` maps a source to its table and to the expression of its source id. The newest row
    per id is taken before the join: that leaves one row per id, whatever number of batches it is in. ``few`` sends
    the ids to the raw rows before these are ranked: right for a handful of golden records, a shuffle more for all.
    """
    refs = golden.select("id_golden", F.explode("ids_origem").alias("fonte", "id_origem"))
    parts = []
    for source, (table, key) in sorted(bronze.items()):
        wanted = refs.where(F.col("fonte") == source)
        raw = table.withColumn("_key", key).where(F.col("_key").isNotNull())
        if few:
            raw = raw.join(wanted.select(F.col("id_origem").alias("_key")).distinct(), "_key", "left_semi")
        newest = latest_per_key(raw, ["_key"])
        payload = F.to_json(F.struct(*sorted(table.columns)), {"ignoreNullFields": "false"})
        rows = newest.select(F.col("_key").alias("id_origem"), payload.alias("registro"))
        # many golden records may point to one placeholder id
        parts.append(wanted.join(shuffled_alone(rows, "id_origem"), "id_origem"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.select("id_golden", "fonte", "id_origem", "registro")


def unique_and_shared(golden: DataFrame) -> DataFrame:
    """Number of entities, and of those known to more than one source."""
    return golden.agg(
        F.count(F.lit(1)).alias("clientes_unicos"),
        F.count_if(F.col("total_fontes") > 1).alias("em_mais_de_uma_subsidiaria"),
    )


def most_shared(golden: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` entities with the most sources."""
    return (
        golden.where(F.col("total_fontes") > 1)
        .select("nome_razao_social", "cpf_cnpj", "total_fontes", "fontes", "id_golden")
        .orderBy(F.desc("total_fontes"), F.asc_nulls_last("nome_razao_social"), "id_golden")
        .limit(k)
        .drop("id_golden")
    )


def entities_per_uf(addresses: DataFrame) -> DataFrame:
    """Distinct entities per state, over address rows ``id_golden, uf`` (see ``list_rows``)."""
    return addresses.groupBy("uf").agg(F.count_distinct("id_golden").alias("clientes"))


def source_quality(metrics: DataFrame, registry: str = "clientes") -> DataFrame:
    return (
        metrics.where((F.col("tipo_cadastro") == registry) & (F.col("fonte") != "_TOTAL"))
        .select("fonte", "registros_prata", "pct_doc_valido", "pct_email", "pct_cidade")
        .orderBy("fonte")
    )
