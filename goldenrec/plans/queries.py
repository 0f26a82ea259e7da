"""Every operator as a query over a folder of star-schema tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import UTC, datetime
from functools import partial, reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenrec.functions import documents as D
from goldenrec.functions import normalize as N
from goldenrec.operators import dirty, lineage, metrics, quality, search
from goldenrec.operators.golden import build_golden, id_conflicts, list_entries, list_rows
from goldenrec.operators.latest import latest_per_key
from goldenrec.operators.paging import Ranked, page_envelopes
from goldenrec.operators.postings import Index, build_index
from goldenrec.operators.resolve import email_owners, resolve_entities
from goldenrec.operators.standardize import SPECS, standardize, union_registry
from goldenrec.plans.catalog import run_sql
from goldenrec.plans.pipeline import GOLD_MODELS, REGISTRIES, SILVER_MODELS, Lake, build_lake, run_pipeline
from goldenrec.schemas import SILVER
from goldenrec.session import concurrently, run_folder, stage
from goldenrec.sources.bronze import Batch, batch_path, ingest, quarantine_path
from goldenrec.sources.readers import (
    bronze_all,
    flatten_documents,
    iso_dates,
    read_batch,
    read_csv_text,
    read_documents,
    read_pages,
)
from goldenrec.sources.registries import TASK_ROWS, derive_all, derive_registry
from goldenrec.streaming.changes import feed_table, start_feed
from goldenrec.streaming.incremental import advance, incremental_table

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = datetime(2024, 2, 1, tzinfo=UTC)
NOW = datetime(2024, 1, 3, tzinfo=UTC)
# Parameters of the read queries; both documents belong to keys the derived registries always have.
DOC_TEXT = "000.125.870-33"
CUSTOMER_ID = hashlib.md5(b"doc:00012587033").hexdigest()
COMPANY_ID = hashlib.md5(b"doc:87932904000104").hexdigest()
LARGE_FROM = 8
# Most files of a micro-batch of the change feed.
FEED_FILES = 24
META = ("_source", "_ingested_at", "_batch_id")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# Layers


def silver(spark: SparkSession, folder: str, source: str, registry: str) -> DataFrame:
    key = (source, registry)
    return standardize(derive_registry(spark, folder, *key), SPECS[key], RUN_TS)


def silver_union(spark: SparkSession, folder: str, registry: str) -> DataFrame:
    return union_registry([silver(spark, folder, *key) for key in SPECS if key[1] == registry])


def stored_union(spark: SparkSession, folder: str, registry: str) -> DataFrame:
    """Silver as a stored table: later steps read it more than once, and their filters then apply to
    its columns instead of repeating the expressions behind them."""
    return stage(silver_union(spark, folder, registry), f"union-{registry}")


def cluster(spark: SparkSession, folder: str, registry: str) -> DataFrame:
    return resolve_entities(stored_union(spark, folder, registry))


def gold(spark: SparkSession, folder: str, registry: str) -> DataFrame:
    clustered = stage(cluster(spark, folder, registry), f"cluster-{registry}")
    return build_golden(clustered, RUN_TS)


def seen_files(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of the tables: what is stored for a session holds only as long as these do."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    told = sorted(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}" for f in files)
    return hashlib.md5("\n".join(told).encode()).hexdigest()


_lakes: dict[tuple[str, str, str], Lake] = {}


def lake(spark: SparkSession, folder: str) -> Lake:
    """The stored lake over ``folder``: built at the first use of a session, then read.

    The read functions are defined on stored gold tables, so their queries start there.
    """
    key = (spark.sparkContext.applicationId, folder, seen_files(spark, folder))
    if key not in _lakes:
        base = f"{run_folder(spark)}/lake-{uuid4()}"
        _lakes[key] = build_lake(derive_all(spark, folder), base, RUN_TS)
    return _lakes[key]


def model(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return lake(spark, folder).tables[name]


# Flat forms: lists and maps as text, so that any engine can compare them


def joined(column: str, missing_as_empty: bool = False) -> Column:
    text = F.array_join(column, "|")
    return (F.coalesce(text, F.lit("")) if missing_as_empty else text).alias(column)


def _address_text(entry: Column) -> Column:
    part = [F.coalesce(entry[name], F.lit("")) for name in ("cidade", "uf")]
    return F.concat(entry["fonte"], F.lit(":"), part[0], F.lit(":"), part[1])


def addresses_text(missing_as_empty: bool = False) -> Column:
    text = F.array_join(F.array_sort(F.transform("enderecos", _address_text)), "|")
    return (F.coalesce(text, F.lit("")) if missing_as_empty else text).alias("enderecos")


def attributes_text() -> Column:
    entries = F.transform(
        "atributos_por_fonte", lambda e: F.concat(e["fonte"], F.lit(":"), e["atributos"])
    )
    return F.array_join(F.array_sort(entries), "|").alias("atributos_por_fonte")


def ids_text() -> Column:
    entries = F.transform(
        F.array_sort(F.map_entries("ids_origem")),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))),
    )
    return F.array_join(entries, "|").alias("ids_origem")


GOLDEN_HEAD = ("id_golden", "cluster_key", "tipo_pessoa", "nome_razao_social", "cpf_cnpj", "cpf_cnpj_kind")


def flat_golden(golden: DataFrame) -> DataFrame:
    return golden.select(
        *GOLDEN_HEAD,
        joined("emails"),
        joined("telefones"),
        addresses_text(),
        joined("fontes"),
        "total_fontes",
        joined("metodos_match"),
        ids_text(),
        attributes_text(),
        "score_completude",
        "primeira_aparicao",
        "ultima_atualizacao",
        "versao",
    )


def flat_summary(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.select(
        "id_golden",
        "nome_razao_social",
        "cpf_cnpj",
        "cpf_cnpj_kind",
        "tipo_pessoa",
        joined("emails", True),
        joined("telefones", True),
        addresses_text(True),
        joined("fontes"),
        "total_fontes",
        "score_completude",
        *more,
    )


def flat_detail(rows: DataFrame) -> DataFrame:
    instants = [
        F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)
        for name in ("primeira_aparicao", "ultima_atualizacao")
    ]
    return flat_summary(
        rows, joined("metodos_match"), ids_text(), attributes_text(), *instants, F.col("versao")
    )


# Query factories


def applied(source: str, registry: str, column: str, result: str, function: Callable[[], Column]) -> Query:
    """One function over one column of every bronze row of a derived registry."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = derive_registry(spark, folder, source, registry)
        return rows.select(column, function().alias(result))

    return query


def standardized(source: str, registry: str) -> Query:
    return lambda spark, folder: silver(spark, folder, source, registry).drop("_processed_at")


def searching(page: int = 1, per_page: int = search.DEFAULT_PER_PAGE, **filters: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        golden = model(spark, folder, "golden_clientes")
        found = search.search(golden, page=page, per_page=per_page, **filters)
        more = [F.lit(found.total).cast("bigint").alias("total"), F.lit(found.has_next).alias("has_next")]
        return flat_summary(found.data, *more)

    return query


_indexes: dict[tuple[str, str, str], str] = {}


def index(spark: SparkSession, folder: str) -> Index:
    """Postings of the stored golden customers: built at the first use of a session, then read."""
    key = (spark.sparkContext.applicationId, folder, seen_files(spark, folder))
    if key not in _indexes:
        root = f"{run_folder(spark)}/postings-{uuid4()}"
        build_index(model(spark, folder, "golden_clientes"), root)
        _indexes[key] = root
    return Index(spark, _indexes[key])


def searching_index(page: int = 1, per_page: int = search.DEFAULT_PER_PAGE, **filters: str) -> Query:
    """The same pages by the stored postings."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        found = index(spark, folder).search(page=page, per_page=per_page, **filters)
        more = [F.lit(found.total).cast("bigint").alias("total"), F.lit(found.has_next).alias("has_next")]
        return flat_summary(found.data, *more)

    return query


def checking(*checks: quality.Check) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return quality.run_contract(lake(spark, folder).tables, checks)

    return query


# Single queries


def latest_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    newest = latest_per_key(events, ["user_id"], "ts", ())
    return newest.select("user_id", "event_id", "event_type", "value", "props")


def latest_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = derive_registry(spark, folder, "empresa_d", "clientes")
    return latest_per_key(rows, ["Documento", "Nome"])


def event_properties(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        N.json_text("props", "k").alias("k"),
        N.json_text("props", "missing").alias("missing"),
    )


def iso_events(spark: SparkSession, folder: str) -> DataFrame:
    return iso_dates(table(spark, folder, "events").select("event_id", "ts"))


def stored_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as one bronze batch: tagged, written, and read back by batch id."""
    base = f"{run_folder(spark)}/bronze-{uuid4()}"
    rows = derive_registry(spark, folder, "empresa_a", "clientes").drop(*META)
    batch = Batch.new(NOW, "lote-1")
    ingest({"clientes": rows.drop("endereco_rua")}, "empresa_a", base, batch)
    return read_batch(spark, base, "empresa_a", "clientes", batch.batch_id)


def landed_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a spreadsheet export, read back as untouched text."""
    path = f"{run_folder(spark)}/csv-{uuid4()}"
    rows = derive_registry(spark, folder, "empresa_d", "clientes").drop(*META)
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(header=True, quoteAll=True, escape='"', **spaces).csv(path)
    return read_csv_text(spark, path)


def landed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Events as documents of uneven shape, flattened to columns."""
    path = f"{run_folder(spark)}/documents-{uuid4()}"
    properties = F.from_json("props", "k int")
    document = F.struct(
        F.col("event_id").cast("string").alias("_id"),
        F.col("event_type").alias("tipo"),
        F.when(F.col("event_type") != "click", F.col("value")).alias("valor"),
        F.when(F.col("user_id") % 2 == 0, properties).alias("props"),
    )
    table(spark, folder, "events").select(F.to_json(document)).write.text(path)
    layout = T.StructType([T.StructField("valor", T.DoubleType())])
    return flatten_documents(read_documents(spark, path), layout)


def landed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Customers cut into page envelopes, landed, and read back as records."""
    path = f"{run_folder(spark)}/pages-{uuid4()}"
    page_envelopes(table(spark, folder, "customer"), "c_custkey", 25).write.json(path)
    layout = table(spark, folder, "customer").schema
    return flatten_documents(read_pages(spark, path, file_per_page=False), layout)


def landed_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed as documents of which some lines are cut short: what was kept, what was set aside."""
    base = f"{run_folder(spark)}/quarantine-{uuid4()}"
    rows = derive_registry(spark, folder, "empresa_d", "clientes").drop(*META)
    line = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    broken = F.endswith("Fone", F.lit("7"))
    rows.select(F.when(broken, F.left(line, F.length(line) - 1)).otherwise(line)).write.text(f"{base}/landing")
    layout = T.StructType([T.StructField(name, T.StringType()) for name in rows.columns])
    frame = flatten_documents(read_documents(spark, f"{base}/landing", corrupt=True), layout)
    batch = Batch.new(NOW, "lote-1")
    written = ingest({"clientes": frame}, "empresa_d", f"{base}/bronze", batch)["clientes"]
    held = spark.read.parquet(quarantine_path(f"{base}/bronze", "empresa_d", "clientes", batch))
    kept = read_batch(spark, f"{base}/bronze", "empresa_d", "clientes", batch.batch_id)
    rows = kept.select("_source", "_batch_id", F.lit(None).cast("string").alias("motivo"), F.lit(1).alias("kept"))
    rows = rows.unionAll(held.select("_source", "_batch_id", "motivo", F.lit(0).alias("kept")))
    counts = rows.groupBy("_source", "_batch_id").agg(
        F.count_if(F.col("kept") == 1).alias("gravados"),
        F.count_if(F.col("kept") == 0).alias("quarentena"),
        F.max("motivo").alias("motivo"),
    )
    told = (F.col("gravados") == written.rows) & (F.col("quarentena") == written.quarantined)
    return counts.withColumn("confere", told)


def incremental_gold(spark: SparkSession, folder: str) -> DataFrame:
    """All customers received in three batches, gold brought up to date after each: the same as one build."""
    base = f"{run_folder(spark)}/incremental-{uuid4()}"
    keys = [key for key in SPECS if key[1] == "clientes"]

    def dealt(key: tuple[str, str]) -> DataFrame:
        """The source's rows, derived once, each with its turn."""
        rows = derive_registry(spark, folder, *key)
        rows = rows.withColumn("turn", F.pmod(F.xxhash64(*rows.columns), F.lit(3)).cast("int"))
        rows.write.partitionBy("turn").parquet(f"{base}/sources/{key[0]}")
        return spark.read.schema(rows.schema).parquet(f"{base}/sources/{key[0]}")

    def land(key: tuple[str, str], rows: DataFrame, turn: int) -> None:
        received = rows.where(F.col("turn") == turn).drop("turn")
        received.write.parquet(batch_path(f"{base}/bronze", *key, Batch(f"lote-{turn}", NOW)))

    sources = dict(zip(keys, concurrently([partial(dealt, key) for key in keys]), strict=True))
    for turn in range(3):
        concurrently([partial(land, key, rows, turn) for key, rows in sources.items()])
        advance(spark, base, RUN_TS)
    return flat_golden(incremental_table(spark, base, "clientes"))


def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a stream of files, the latest days first: the newest event of each user as the feed leaves it."""
    path = f"{run_folder(spark)}/feed-{uuid4()}"
    events = table(spark, folder, "events")
    # files and micro-batches of a bounded size, also if all events are of one day or one instant
    files = max(4, -(-events.count() // TASK_ROWS))
    events.repartitionByRange(files, F.desc("ts"), "event_id").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", min(FEED_FILES, files // 2)).parquet(f"{path}/in")
    start_feed(stream, f"{path}/feed", ["user_id"], order="ts", then=()).awaitTermination()
    newest = feed_table(spark, f"{path}/feed", stream.schema)
    return newest.select("user_id", "event_id", "event_type", "value", "props")


def sql_normalizers(spark: SparkSession, folder: str) -> DataFrame:
    """The normalisers called from SQL."""
    N.register_sql_functions(spark)
    return spark.sql(
        """select `Nome`, clean_nome(`Nome`) as nome, clean_doc(`Documento`) as doc,
             doc_kind(clean_doc(`Documento`)) as kind, doc_valid(clean_doc(`Documento`)) as valido,
             tipo_pessoa_from_doc(clean_doc(`Documento`)) as tipo, to_e164(`Fone`) as fone,
             clean_email(`Email`) as mail, clean_uf(right(trim(`Endereco`), 2)) as uf,
             id_unicad('empresa_d', clean_doc(`Documento`)) as id
           from {lines}""",
        lines=derive_registry(spark, folder, "empresa_d", "clientes"),
    )


def sql_views(spark: SparkSession, folder: str) -> DataFrame:
    """A user's SQL over the named views of a stored lake."""
    for name, frame in lake(spark, folder).tables.items():
        frame.createOrReplaceTempView(name)
    return run_sql(
        spark,
        """with places as (
             select id_golden, e.uf from golden_clientes lateral view explode(enderecos) t as e)
           select p.uf, count(distinct g.id_golden) as clientes, max(g.score_completude) as melhor
           from golden_clientes g join places p on g.id_golden = p.id_golden
           where g.total_fontes > 1 group by p.uf""",
    )


def all_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return bronze_all(list(derive_all(spark, folder).values()))


def owners(spark: SparkSession, folder: str) -> DataFrame:
    return email_owners(stored_union(spark, folder, "clientes"))


def clustered(registry: str) -> Query:
    return lambda spark, folder: cluster(spark, folder, registry).drop("_processed_at")


def golden(registry: str) -> Query:
    return lambda spark, folder: flat_golden(gold(spark, folder, registry))


def golden_score(spark: SparkSession, folder: str) -> DataFrame:
    golden = gold(spark, folder, "clientes")
    return golden.select("id_golden", "total_fontes", "score_completude")


def golden_ids(spark: SparkSession, folder: str) -> DataFrame:
    golden = gold(spark, folder, "fornecedores")
    return golden.select("cluster_key", F.explode("ids_origem").alias("fonte", "id_origem"))


def golden_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as records of which all returned ones carry one placeholder document.

    That cluster has a third of all rows; its lists are as complete as those of any other. Repeated once per record, its
    attributes would be beyond what a row can hold at some 110 million line items, so they come counted.
    """
    lines = table(spark, folder, "lineitem")
    doc = F.when(F.col("l_returnflag") == "R", F.lit("00000000191")).otherwise(
        F.lpad(F.col("l_suppkey").cast("string"), 11, "5")
    )
    own = {
        "id_unicad": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "fonte": F.concat(F.lit("empresa_"), F.lower("l_linestatus")),
        "id_origem": F.col("l_orderkey").cast("string"),
        "tipo_pessoa": F.when(F.col("l_linenumber") > 1, "PF"),
        "nome_razao_social": F.concat(F.lit("Item "), F.col("l_partkey").cast("string")),
        "cpf_cnpj": doc,
        "cpf_cnpj_kind": F.lit("CPF"),
        "cpf_cnpj_valido": F.lit(True),
        "email": F.concat(F.lit("p"), F.col("l_partkey").cast("string"), F.lit("@x.com")),
        "uf": F.col("l_linestatus"),
        "atributos_extras": F.col("l_quantity").cast("int").cast("string"),
        "_ingested_at": F.col("l_shipdate").cast("string"),
    }
    rows = lines.select([own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SILVER])
    golden = build_golden(stage(resolve_entities(rows), "hot-clusters"), RUN_TS, counted=True)
    places = F.array_join(F.transform("enderecos", lambda e: F.concat_ws(":", e["fonte"], e["uf"])), "|")

    def over_records(value: Callable[[Column], Column]) -> Column:
        add = lambda total, e: total + value(e) * e["registros"]
        return F.aggregate("atributos_por_fonte", F.lit(0).cast("bigint"), add)

    return golden.select(
        "cluster_key",
        F.size("emails").cast("bigint").alias("emails"),
        F.md5(F.array_join("emails", "|")).alias("emails_md5"),
        places.alias("enderecos"),
        over_records(lambda e: F.lit(1).cast("bigint")).alias("atributos"),
        over_records(lambda e: e["atributos"].cast("bigint")).alias("soma"),
        ids_text(),
        "nome_razao_social",
        "score_completude",
    )


def golden_large(spark: SparkSession, folder: str) -> DataFrame:
    """Golden heads, marked where a cluster has more than a few records."""
    return gold(spark, folder, "clientes").select(
        *GOLDEN_HEAD,
        joined("fontes"),
        joined("metodos_match"),
        ids_text(),
        "score_completude",
        "primeira_aparicao",
        "ultima_atualizacao",
        (F.size("atributos_por_fonte") > LARGE_FROM).alias("em_listas"),
    )


def golden_large_lists(spark: SparkSession, folder: str) -> DataFrame:
    """List entries, with their number of records, of clusters with more than a few records."""
    clusters = stage(cluster(spark, folder, "clientes"), "cluster-clientes")
    large = clusters.groupBy(F.col("cluster_key").alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    large = large.where(F.col("n") > LARGE_FROM)
    same = F.col("cluster_key").eqNullSafe(F.col("_key"))
    return list_entries(clusters).join(large, same, "left_semi")


def golden_addresses(spark: SparkSession, folder: str) -> DataFrame:
    return list_rows(gold(spark, folder, "clientes"), "enderecos")


def conflicts(spark: SparkSession, folder: str) -> DataFrame:
    return id_conflicts(cluster(spark, folder, "clientes"))


def quality_table(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics straight from bronze: every layer before them is rebuilt."""

    def layers(registry: str) -> tuple[DataFrame, DataFrame]:
        union = stored_union(spark, folder, registry)
        clusters = stage(resolve_entities(union), f"cluster-{registry}")
        return union, build_golden(clusters, RUN_TS)

    (silver_c, golden_c), (silver_f, golden_f) = concurrently(
        [partial(layers, registry) for registry in REGISTRIES]
    )
    return metrics.quality_metrics(silver_c, silver_f, golden_c, golden_f)


def partial_lake(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per model of a lake into which two of the seven registries were ever loaded."""
    base = f"{run_folder(spark)}/partial-{uuid4()}"
    for source, kind in (("empresa_a", "clientes"), ("empresa_c", "fornecedores")):
        rows = derive_registry(spark, folder, source, kind).drop(*META)
        ingest({kind: rows}, source, f"{base}/bronze", Batch.new(NOW, "lote-1"))
    tables = run_pipeline(spark, base, RUN_TS, since=(NOW.year, NOW.month)).tables
    counts = [
        tables[name].agg(F.lit(name).alias("modelo"), F.count(F.lit(1)).alias("registros"))
        for name in (*SILVER_MODELS, *GOLD_MODELS[:4])
    ]
    return reduce(DataFrame.unionAll, counts)


def histogram(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.overlap_histogram(model(spark, folder, "golden_clientes"))


_ranked: dict[tuple[str, str, str], str] = {}


def deep_page(spark: SparkSession, folder: str) -> DataFrame:
    """A page of line items by price far behind the first ones, from the stored ranks.

    They are stored at the first use of a session, then read.
    """
    key = (spark.sparkContext.applicationId, folder, seen_files(spark, folder))
    if key not in _ranked:
        lines = table(spark, folder, "lineitem").withColumn(
            "line_id", F.col("l_orderkey") * 8 + F.col("l_linenumber")
        )
        chosen = lines.groupBy("line_id").agg(
            F.max("l_extendedprice").alias("price"), F.max("l_returnflag").alias("flag")
        )
        root = f"{run_folder(spark)}/ranked-{uuid4()}"
        Ranked.build(chosen, root, "line_id", [("flag", False), ("price", True)], range_rows=20_000)
        _ranked[key] = root
    return Ranked(spark, _ranked[key]).page(301, 100)


def customer_detail(spark: SparkSession, folder: str) -> DataFrame:
    return flat_detail(search.detail_rows(model(spark, folder, "golden_clientes"), CUSTOMER_ID))


def company(spark: SparkSession, folder: str) -> DataFrame:
    customers, suppliers = (model(spark, folder, f"golden_{r}") for r in ("clientes", "fornecedores"))
    return flat_detail(search.resolve_entity_rows(customers, suppliers, COMPANY_ID))


def company_all(spark: SparkSession, folder: str) -> DataFrame:
    customers, suppliers = (model(spark, folder, f"golden_{r}") for r in ("clientes", "fornecedores"))
    found = search.resolve_entity_all(customers, suppliers, COMPANY_ID)
    return found.select("registro", "id_golden", "cpf_cnpj", "nome_razao_social", "total_fontes")


def table_health(spark: SparkSession, folder: str) -> DataFrame:
    customers, suppliers = (model(spark, folder, f"golden_{r}") for r in ("clientes", "fornecedores"))
    return search.health(customers, suppliers)


def metrics_listing(spark: SparkSession, folder: str) -> DataFrame:
    return search.list_metrics(model(spark, folder, "metricas_qualidade"))


def unique_customers(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.unique_and_shared(model(spark, folder, "golden_clientes"))


def shared_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    top = lineage.most_shared(model(spark, folder, "golden_fornecedores"))
    return top.withColumn("fontes", joined("fontes"))


def customers_per_uf(spark: SparkSession, folder: str) -> DataFrame:
    counts = lineage.entities_per_uf(list_rows(model(spark, folder, "golden_clientes"), "enderecos"))
    return counts.orderBy(F.desc("clientes"), F.asc_nulls_last("uf")).limit(5)


def source_quality(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.source_quality(model(spark, folder, "metricas_qualidade"))


def lineage_of(spark: SparkSession, folder: str, id_golden: str | None = None) -> DataFrame:
    return lineage.lineage(
        model(spark, folder, "golden_clientes"), model(spark, folder, "int_clientes_cluster"), id_golden
    )


def lineage_one(spark: SparkSession, folder: str) -> DataFrame:
    return lineage_of(spark, folder, CUSTOMER_ID)


def source_lookup(spark: SparkSession, folder: str) -> DataFrame:
    keys = {
        "empresa_a": F.col("id").cast("string"),
        "empresa_b": F.col("client_id").cast("string"),
        "empresa_d": N.clean_doc("Documento"),
        "empresa_e": F.col("id"),
    }
    tables = {
        source: (model(spark, folder, f"{source}_clientes"), key) for source, key in keys.items()
    }
    return lineage.source_records(model(spark, folder, "golden_clientes"), tables)


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    pages = page_envelopes(table(spark, folder, "customer"), "c_custkey", 25)
    return pages.select(
        "page",
        "per_page",
        "total",
        "has_next",
        F.size("data").cast("bigint").alias("registros"),
        F.to_json("data").alias("data"),
    )


def freshness(spark: SparkSession, folder: str) -> DataFrame:
    sources = {f"{source}_{kind}": frame for (source, kind), frame in derive_all(spark, folder).items()}
    return quality.freshness(sources, NOW).select(
        "unique_id", F.round("age_hours", 6).alias("age_hours"), "status"
    )


def check_history(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream read as a history of source checks."""
    status = (
        F.when(F.col("event_type") == "error", "runtime_error")
        .when(F.col("value") > 90, "warn")
        .otherwise("pass")
    )
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("unique_id"),
        status.alias("status"),
        F.col("ts").alias("generated_at"),
    )


def freshness_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.latest_checks(check_history(spark, folder))


def freshness_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return quality.freshness_rollup(check_history(spark, folder))


_ANOMALY = ("execucoes_base", "anomalia")


def _scores() -> list[Column]:
    return [F.round(name, 6).alias(name) for name in ("media", "desvio", "z")]


def volume_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per day as the row counts of daily runs."""
    runs = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("run_ts"))
        .agg(F.count(F.lit(1)).alias("registros"))
        .withColumn("tabela", F.lit("orders"))
    )
    scored = quality.anomalies(runs)
    return scored.select(
        "tabela", F.col("run_ts").cast("string").alias("dia"), "registros", *_ANOMALY, *_scores()
    )


def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as three runs saw them: a column comes, then one goes and one changes its type."""
    base = f"{run_folder(spark)}/schema-{uuid4()}"
    customers = table(spark, folder, "customer")
    versions_ = (
        customers.drop("c_mktsegment"),
        customers,
        customers.drop("c_nationkey").withColumn("c_acctbal", F.col("c_acctbal").cast("string")),
    )
    for day, version in enumerate(versions_, 1):
        quality.schema_run(version, "customer", datetime(2024, 1, day, tzinfo=UTC)).write.parquet(f"{base}/{day}")
    history = spark.read.option("recursiveFileLookup", True).parquet(base)
    return quality.schema_drift(history).withColumn("run_ts", F.date_format("run_ts", "yyyy-MM-dd"))


def dimension_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    """Events per type and day."""
    runs = (
        table(spark, folder, "events")
        .groupBy("event_type", F.col("ts").cast("date").alias("run_ts"))
        .agg(F.count(F.lit(1)).alias("registros"))
    )
    scored = quality.anomalies(runs, ("event_type",))
    return scored.select(
        "event_type", F.col("run_ts").cast("string").alias("dia"), "registros", *_ANOMALY, *_scores()
    )


def dirty_spellings(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer row misspelt by rules of its key, some of them twice."""
    customers = table(spark, folder, "customer")
    key = F.col("c_custkey")
    percent = F.pmod(key * 37, F.lit(100))
    doc = F.lpad((key * 48271).cast("string"), 11, "0")
    phone = F.concat(F.lit("55119"), F.lpad(key.cast("string"), 8, "0"))
    name = F.concat(F.lit("José "), F.col("c_name"))
    spelt = customers.select(
        "c_custkey",
        dirty.text_spelling(name, percent).alias("Nome"),
        dirty.doc_spelling(doc, percent, 33).alias("Documento"),
        dirty.phone_spelling(phone, key).alias("Fone"),
        dirty.blank_some(F.concat(F.lit("c"), key.cast("string"), F.lit("@x.com")), percent, 12).alias("Email"),
    )
    return dirty.repeat_rows(spelt, F.pmod(F.col("c_custkey") * 37, F.lit(100)), 5)


def _union_query(registry: str) -> Query:
    return lambda spark, folder: silver_union(spark, folder, registry).drop("_processed_at")


CONTRACT_RULES = {
    rule: [c for c in quality.CONTRACT if c.rule == rule and not c.where]
    for rule in ("not_null", "unique", "accepted_values")
}

def check_digits(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned document is a column of its own: the digit arithmetic refers to it many times."""
    lines = derive_registry(spark, folder, "empresa_d", "clientes").withColumn("doc", N.clean_doc("Documento"))
    lines = lines.withColumn("digitos", D.expected_check_digits("doc"))
    return lines.select("Documento", "digitos", D.check_digits_ok("doc", "digitos").alias("confere"))


def packed_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = derive_registry(spark, folder, "empresa_c", "fornecedores")
    kept = [F.col(name) for name in ("_id", "avaliacao_media", "observacoes", "endereco")]
    return rows.select(
        "_id",
        N.json_text("endereco", "cidade").alias("cidade"),
        N.json_text("endereco", "numero").alias("numero"),
        N.pack_json(*kept).alias("texto"),
    )


def addresses(spark: SparkSession, folder: str) -> DataFrame:
    lines = derive_registry(spark, folder, "empresa_d", "fornecedores")
    return lines.select(
        "Endereco", N.address_city("Endereco").alias("cidade"), N.address_uf("Endereco").alias("uf")
    )


def _golden_id() -> Column:
    return F.md5(F.concat(F.lit("doc:"), N.clean_doc("cnpj")))


def on_doc(function: Callable[[Column], Column], column: str) -> Callable[[], Column]:
    return lambda: function(N.clean_doc(column))


QUERIES: dict[str, Query] = {
    "norm_clean_doc": applied("empresa_d", "clientes", "Documento", "doc", lambda: N.clean_doc("Documento")),
    "norm_doc_kind": applied("empresa_a", "clientes", "cpf_cnpj", "kind", on_doc(N.doc_kind, "cpf_cnpj")),
    "norm_doc_valid": applied("empresa_a", "clientes", "cpf_cnpj", "valido", on_doc(N.doc_valid, "cpf_cnpj")),
    "norm_tipo_pessoa": applied("empresa_d", "clientes", "Documento", "tipo", on_doc(N.person_type, "Documento")),
    "norm_e164": applied("empresa_d", "fornecedores", "Fone", "e164", lambda: N.to_e164("Fone")),
    "norm_email": applied("empresa_a", "clientes", "email", "limpo", lambda: N.clean_email("email")),
    "norm_nome": applied("empresa_b", "clientes", "full_name", "nome", lambda: N.clean_name("full_name")),
    "norm_uf": applied("empresa_a", "clientes", "endereco_uf", "uf", lambda: N.clean_uf("endereco_uf")),
    "addr_city_uf": addresses,
    "id_unicad": applied("empresa_a", "fornecedores", "id", "id_unicad", lambda: N.record_id("empresa_a", "id")),
    "id_golden": applied("empresa_c", "fornecedores", "cnpj", "id_golden", _golden_id),
    "json_extract": event_properties,
    "json_pack": packed_documents,
    "doc_mask": applied("empresa_d", "clientes", "Documento", "mascara", on_doc(D.mask_doc, "Documento")),
    "doc_check_digits": check_digits,
    "deaccent": applied("empresa_d", "fornecedores", "Endereco", "texto", lambda: D.deaccent("Endereco")),
    "strip_punct": applied("empresa_a", "clientes", "cpf_cnpj", "digitos", lambda: D.strip_punct("cpf_cnpj")),
    "dirty_spellings": dirty_spellings,
    "latest_per_key": latest_events,
    "latest_per_composite_key": latest_lines,
    **{spec.model.removeprefix("stg_").replace("empresa", "std"): standardized(*key) for key, spec in SPECS.items()},
    "union_clientes": _union_query("clientes"),
    "union_fornecedores": _union_query("fornecedores"),
    "iso_dates": iso_events,
    "bronze_batch": stored_batch,
    "landed_csv": landed_csv,
    "landed_documents": landed_documents,
    "landed_pages": landed_pages,
    "landed_quarantine": landed_quarantine,
    "bronze_all": all_bronze,
    "email_to_cluster": owners,
    "cluster_clientes": clustered("clientes"),
    "cluster_fornecedores": clustered("fornecedores"),
    "golden_clientes": golden("clientes"),
    "golden_fornecedores": golden("fornecedores"),
    "golden_score": golden_score,
    "golden_ids_origem": golden_ids,
    "golden_large_clusters": golden_large,
    "golden_large_lists": golden_large_lists,
    "golden_hot_cluster": golden_hot,
    "golden_list_rows": golden_addresses,
    "id_conflicts": conflicts,
    "metricas_qualidade": quality_table,
    "overlap_histogram": histogram,
    "lake_of_two_sources": partial_lake,
    "incremental_gold": incremental_gold,
    "change_feed": change_feed,
    "search_name": searching(q="customer 00000"),
    "search_doc": searching(doc=DOC_TEXT),
    "search_name_index": searching_index(q="customer 00000"),
    "search_email": searching_index(email="CLIENTE12"),
    "search_phone": searching_index(telefone="+55 (21) 9"),
    "search_all_index": searching_index(q="cust%r 0_0", email="cliente", telefone="55", per_page=100),
    "search_city": searching(cidade="paraná"),
    "search_uf": searching(uf="sp", q="%cia_2"),
    "search_page2": searching(page=2, per_page=40, cidade="São"),
    "search_no_digits": searching(doc="abc", per_page=100),
    "page_deep": deep_page,
    "detail": customer_detail,
    "resolve_entity": company,
    "resolve_entity_all": company_all,
    "health": table_health,
    "metrics_listing": metrics_listing,
    "sql_normalizers": sql_normalizers,
    "sql_views": sql_views,
    "sql_unique": unique_customers,
    "sql_shared_suppliers": shared_suppliers,
    "sql_by_uf": customers_per_uf,
    "sql_quality": source_quality,
    "lineage": lineage_of,
    "lineage_one": lineage_one,
    "source_lookup": source_lookup,
    "page_envelope": envelopes,
    "dq_not_null": checking(*CONTRACT_RULES["not_null"]),
    "dq_unique": checking(*CONTRACT_RULES["unique"]),
    "dq_accepted": checking(*CONTRACT_RULES["accepted_values"]),
    "dq_accepted_where": checking(*[c for c in quality.CONTRACT if c.where]),
    "freshness": freshness,
    "freshness_counts": freshness_counts,
    "freshness_rollup": freshness_rollup,
    "volume_anomaly": volume_anomaly,
    "dimension_anomaly": dimension_anomaly,
    "schema_drift": schema_drift,
}
