"""Golden records: one row per cluster, with the lineage of every source record."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.operators.standardize import run_stamp
from goldenrec.schemas import GOLDEN
from goldenrec.session import stage

LIST_COLUMNS = ("emails", "telefones", "enderecos", "atributos_por_fonte")
# All that golden records are made of.
MEMBER_COLUMNS = (
    "cluster_key",
    "match_method",
    "fonte",
    "id_origem",
    "tipo_pessoa",
    "nome_razao_social",
    "cpf_cnpj",
    "cpf_cnpj_kind",
    "cpf_cnpj_valido",
    "email",
    "telefone_principal",
    "cidade",
    "uf",
    "atributos_extras",
    "_ingested_at",
)
# Records up to which a cluster may be collected whole: some 400 bytes each.
SMALL = 1_000
# Internal key of the rows without a cluster key; real keys are never empty.
NO_KEY = ""


def _person_type() -> Column:
    """Most frequent value, the smaller one on a tie."""
    return F.mode("tipo_pessoa", deterministic=True)


def _longest_name() -> Column:
    """Longest name; among equally long ones the greatest, so that every run agrees."""
    name = F.col("nome_razao_social")
    ranked = F.when(name.isNotNull(), F.struct(F.length(name).alias("size"), name.alias("name")))
    return F.max(ranked)["name"]


def _facts() -> list[Column]:
    """Aggregates whose state stays small however large the cluster is."""
    valid = F.col("cpf_cnpj_valido")
    return [
        _person_type().alias("tipo_pessoa"),
        _longest_name().alias("nome_razao_social"),
        # all valid documents of a cluster are equal
        F.max(F.when(valid, F.col("cpf_cnpj"))).alias("cpf_cnpj"),
        F.max(F.when(valid, F.col("cpf_cnpj_kind"))).alias("cpf_cnpj_kind"),
        F.array_sort(F.collect_set("fonte")).alias("fontes"),
        F.array_sort(F.collect_set("match_method")).alias("metodos_match"),
        F.min("_ingested_at").alias("primeira_aparicao"),
        F.max("_ingested_at").alias("ultima_atualizacao"),
    ]


def _entries(keyed: DataFrame) -> DataFrame:
    """List entries as rows, distinct per cluster and list; ``n`` counts their records.

    Grouping by cluster *and* value spreads one large cluster over all tasks, and equal entries of a
    task are one row before the shuffle.
    """
    none = F.lit(None).cast("string")

    def entry(name: str, wanted: Column, **values: Column) -> Column:
        fields = [F.lit(name).alias("lista")]
        for column in ("valor", "cidade", "uf", "fonte"):
            fields.append(values.get(column, none).alias(column))
        return F.when(wanted, F.struct(*fields))

    has_address = F.col("cidade").isNotNull() | F.col("uf").isNotNull()
    fonte = F.col("fonte")
    parts = F.array(
        entry("emails", F.col("email").isNotNull(), valor=F.col("email")),
        entry("telefones", F.col("telefone_principal").isNotNull(), valor=F.col("telefone_principal")),
        entry("enderecos", has_address, cidade=F.col("cidade"), uf=F.col("uf"), fonte=fonte),
        entry("atributos_por_fonte", F.lit(True), valor=F.col("atributos_extras"), fonte=fonte),
    )
    rows = keyed.select("key", F.explode(F.array_compact(parts)).alias("entry")).select("key", "entry.*")
    return rows.groupBy("key", "lista", "valor", "cidade", "uf", "fonte").agg(F.count(F.lit(1)).alias("n"))


def list_entries(clustered: DataFrame) -> DataFrame:
    """``id_golden, cluster_key, lista, valor, cidade, uf, fonte, registros``: the entries of all lists
    as rows, each once per cluster with the number of records that have it."""
    keyed = clustered.withColumn("key", F.coalesce("cluster_key", F.lit(NO_KEY)))
    key = F.when(F.col("key") != NO_KEY, F.col("key"))
    names = ["lista", "valor", "cidade", "uf", "fonte", F.col("n").alias("registros")]
    return _entries(keyed).select(F.md5(key).alias("id_golden"), key.alias("cluster_key"), *names)


def _lists(counted: bool) -> list[Column]:
    """The lists as they stay: a projection behind the aggregate would copy a large cluster's row once more."""

    def of(name: str, value: Column) -> Column:
        return F.collect_list(F.when(F.col("lista") == name, value))

    def ordered(name: str, value: Column) -> Column:
        # compares in place, where array_sort calls a lambda for two boxed entries
        return F.sort_array(of(name, value))

    def filled(name: str, value: Column) -> Column:
        return F.when(F.size(of(name, value)) > 0, ordered(name, value)).alias(name)

    valor, fonte = F.col("valor"), F.col("fonte")
    if counted:
        attributes = F.struct(fonte, valor.alias("atributos"), F.col("n").alias("registros"))
    else:
        attributes = F.struct(F.struct(fonte, valor.alias("atributos")).alias("entry"), F.col("n").cast("int").alias("n"))
    return [
        filled("emails", valor),
        filled("telefones", valor),
        filled("enderecos", F.struct("cidade", "uf", "fonte")),
        ordered("atributos_por_fonte", attributes).alias("atributos_por_fonte"),
        ordered("ids", F.struct("fonte", valor.alias("id"), "n")).alias("_ids"),
    ]


def _ids(keyed: DataFrame) -> DataFrame:
    """The smallest id of each source of a cluster as an entry; ``n`` is 2 if the source has another.

    Combined per source before the shuffle: however many ids a cluster has, one entry a source comes together.
    """
    same = F.min("id_origem").eqNullSafe(F.max("id_origem")) & F.count("id_origem").isin(F.lit(0), F.count(F.lit(1)))
    by_source = keyed.where(F.col("fonte").isNotNull()).groupBy("key", "fonte").agg(
        F.min("id_origem").alias("valor"), F.when(same, 1).otherwise(2).cast("long").alias("n")
    )
    none = F.lit(None).cast("string")
    return by_source.select(
        "key", F.lit("ids").alias("lista"), "valor", none.alias("cidade"), none.alias("uf"), "fonte", "n"
    )


def _ids_by_source(strict: bool) -> Column:
    """``source -> id``; the smallest id when a source has several (``strict`` fails instead)."""
    ids = F.map_from_entries(F.transform("_ids", lambda one: F.struct(one["fonte"], one["id"])))
    if not strict:
        return ids
    problem = F.concat(F.lit("several source ids for one source in cluster "), F.col("cluster_key"))
    clash = F.exists("_ids", lambda one: one["n"] > 1)
    return F.when(clash, F.raise_error(F.coalesce(problem, F.lit("NULL cluster")))).otherwise(ids)


def _score() -> Column:
    """Share of the 8 completeness dimensions that hold; the records' attributes always do."""
    dimensions = [F.col(name).isNotNull() for name in ("nome_razao_social", "cpf_cnpj", *LIST_COLUMNS[:3], "tipo_pessoa")]
    dimensions += [F.size("fontes") > 1, F.lit(True)]
    points = sum((flag.cast("int") for flag in dimensions), F.lit(0))
    return points.cast("double") / F.lit(8.0)


def build_golden(
    clustered: DataFrame, run_ts: datetime | None = None, *, strict: bool = False, counted: bool = False
) -> DataFrame:
    """Golden records of a clustered registry, with all lists complete at every cluster size.

    Facts, ids and list entries are aggregated apart, all combined before their shuffle; only the distinct
    entries of a cluster and one id a source come together, in its row. ``strict`` fails when one source brings several ids
    into a cluster; see ``id_conflicts`` for the report. Lists beyond what one row can hold are an error.

    ``atributos_por_fonte`` has an entry per record, some 56 bytes each: a cluster of 38 million records is beyond a row.
    With ``counted`` it has each distinct entry once, with the ``registros`` that have it: as complete, and no longer
    than the other lists.
    """
    keyed = clustered.withColumn("key", F.coalesce("cluster_key", F.lit(NO_KEY)))
    facts = keyed.groupBy("key").agg(*_facts())
    lists = _entries(keyed).unionByName(_ids(keyed)).groupBy("key").agg(*_lists(counted))
    # both sides are already partitioned by the key, which is never NULL; the right side's rows, the small ones, are
    # held beside those of the left one
    frame = lists.join(facts, "key")
    if not counted:
        repeated = F.transform("atributos_por_fonte", lambda one: F.array_repeat(one["entry"], one["n"]))
        frame = frame.withColumn("atributos_por_fonte", F.flatten(repeated))
    return _records(frame, run_ts, strict, counted)


def _records(frame: DataFrame, run_ts: datetime | None, strict: bool, counted: bool = False) -> DataFrame:
    """Golden records of facts, lists and ids by ``key``."""
    frame = frame.withColumn("cluster_key", F.when(F.col("key") != NO_KEY, F.col("key")))
    computed = frame.withColumn("ids_origem", _ids_by_source(strict)).withColumns(
        {
            "id_golden": F.md5("cluster_key"),
            "total_fontes": F.size("fontes").cast("bigint"),
            "score_completude": _score(),
            "versao": F.lit(1),
            "_processed_at": run_stamp(run_ts),
        }
    )
    columns = {c.name: F.col(c.name).cast(c.dataType).alias(c.name) for c in GOLDEN}
    if counted:
        columns["atributos_por_fonte"] = F.col("atributos_por_fonte")
    return computed.select(*columns.values())


def _collected(keyed: DataFrame, run_ts: datetime | None, strict: bool) -> DataFrame:
    """Golden records of clusters of few records, which are collected whole: each record is shuffled once."""
    fonte = F.col("fonte")
    has_address = F.col("cidade").isNotNull() | F.col("uf").isNotNull()
    record = F.struct(
        "email",
        "telefone_principal",
        F.when(has_address, F.struct("cidade", "uf", "fonte")).alias("endereco"),
        F.struct(fonte, F.col("atributos_extras").alias("atributos")).alias("atributo"),
        F.struct(fonte, F.col("id_origem").alias("id")).alias("id"),
    )
    # dealt as records, so that no aggregation buffers are shuffled
    frame = keyed.repartition("key").groupBy("key").agg(*_facts(), F.collect_list(record).alias("_all"))

    def filled(field: str) -> Column:
        """Distinct values of the field in order, without NULL; NULL if there are none."""
        some = F.array_compact(F.array_distinct(f"_all.{field}"))
        return F.when(F.size(some) > 0, F.sort_array(some))

    def ids_of(source: Column) -> Column:
        return F.filter("_pairs", lambda one: one["fonte"] == source)

    def smallest(source: Column) -> Column:
        ids = F.transform(ids_of(source), lambda one: one["id"])
        return F.struct(source.alias("fonte"), F.array_min(ids).alias("id"), F.size(ids).alias("n"))

    frame = frame.withColumn("_pairs", F.array_distinct("_all.id")).withColumns(
        {
            "emails": filled("email"),
            "telefones": filled("telefone_principal"),
            "enderecos": filled("endereco"),
            "atributos_por_fonte": F.sort_array("_all.atributo"),
            "_ids": F.transform("fontes", smallest),
        }
    )
    return _records(frame, run_ts, strict)


def build_golden_by_size(clustered: DataFrame, run_ts: datetime | None = None, *, strict: bool = False) -> DataFrame:
    """The records of ``build_golden``, at less cost where most clusters are small; ``clustered`` is a stored table.

    Clusters of up to SMALL records are collected whole, the others go through ``build_golden``.
    """
    keyed = clustered.withColumn("key", F.coalesce("cluster_key", F.lit(NO_KEY)))
    large = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SMALL).select("key")
    large = stage(large, "large-clusters")
    if large.isEmpty():
        return _collected(keyed, run_ts, strict)
    small = _collected(keyed.join(large, "key", "left_anti"), run_ts, strict)
    return small.unionByName(build_golden(keyed.join(large, "key", "left_semi").drop("key"), run_ts, strict=strict))


def id_conflicts(clustered: DataFrame) -> DataFrame:
    """Clusters in which one source has several ids: the ids the golden map had to leave out."""
    return (
        clustered.groupBy("cluster_key", "fonte", "id_origem")
        .agg(F.count(F.lit(1)).alias("registros"))
        .groupBy("cluster_key", "fonte")
        .agg(F.count(F.lit(1)).alias("ids"), F.min("id_origem").alias("id_mantido"))
        .where(F.col("ids") > 1)
    )


def list_rows(golden: DataFrame, column: str) -> DataFrame:
    """One list column as rows: ``id_golden`` plus ``valor``, or the fields of its entries."""
    rows = golden.select("id_golden", F.explode(column).alias("valor"))
    return rows.select("id_golden", "valor.*") if column in LIST_COLUMNS[2:] else rows
