"""Plans the operators must have to hold at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from goldenrec.operators import search
from goldenrec.operators.golden import build_golden
from goldenrec.operators.latest import latest_per_key
from goldenrec.operators.lineage import source_records
from goldenrec.operators.resolve import resolve_entities
from goldenrec.plans.queries import QUERIES, lake, silver
from goldenrec.schemas import SILVER
from goldenrec.session import stage
from goldenrec.sources import registries
from helpers import DEFAULTS, RUN_TS

SF = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_newest_rows_are_limited_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("_ingested_at"))
    text = plan(latest_per_key(frame, ["k"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("page_deep", "page_envelope")])
def test_no_python_and_no_cross_product(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_rows_with_a_document_skip_the_lookup_shuffle(spark):
    union = stage(silver(spark, SF, "empresa_a", "clientes"), "plan")
    text = plan(resolve_entities(union))
    branches = re.split(r"\n(?=:- |\+- )", text[text.index("Union") :])
    assert len([b for b in branches if "Exchange" in b and "Join" in b]) == 1
    assert "PushedFilters" in text and "IsNotNull(email)" in text


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


@pytest.fixture
def small_skew(spark):
    """Thresholds at which a few thousand rows already count as a hot partition."""
    before = {key: spark.conf.get(key, None) for key in SKEW}
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def hot_rows(spark, **values):
    """Silver-like rows over eight files; a third of them share one value."""
    number = F.col("id")
    base = {name: F.lit(value) for name, value in DEFAULTS.items()}
    base.update(id_unicad=F.md5(number.cast("string")), id_origem=number.cast("string"), **values)
    rows = spark.range(0, 30_000, 1, 8)
    return stage(rows.select([base[f.name].cast(f.dataType).alias(f.name) for f in SILVER]), "hot")


def test_a_shared_address_is_split_over_tasks(spark, small_skew):
    number = F.col("id")
    doc = F.when(number % 3 == 1, F.lpad(number.cast("string"), 11, "9"))
    email = F.when(number % 3 == 0, F.lit("hot@x.y")).otherwise(F.concat(number.cast("string"), F.lit("@x.y")))
    rows = hot_rows(spark, cpf_cnpj=doc, cpf_cnpj_valido=doc.isNotNull(), email=email)
    resolved = resolve_entities(rows)
    assert len(resolved.collect()) == 30_000
    assert "SortMergeJoin(skew=true)" in plan(resolved)


def test_a_placeholder_source_id_is_split_over_tasks(spark, small_skew):
    key = F.when(F.col("id") % 3 == 0, "0").otherwise(F.col("id").cast("string"))
    golden = spark.range(0, 30_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("id_golden"),
        F.create_map(F.lit("empresa_d"), key).alias("ids_origem"),
    )
    bronze = spark.range(0, 30_000, 1, 8).select(
        key.alias("Documento"), F.lit("2024").alias("_ingested_at"), F.lit("b").alias("_batch_id")
    )
    found = source_records(golden, {"empresa_d": (bronze, F.col("Documento"))})
    assert len(found.collect()) == 30_000
    assert "SortMergeJoin(skew=true)" in plan(found)


def test_golden_combines_before_every_shuffle(spark):
    """Facts once; list entries by cluster and value, ids by cluster and source, both then by cluster; the join no other."""
    clustered = stage(resolve_entities(stage(silver(spark, SF, "empresa_a", "clientes"), "plan")), "plan")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(build_golden(clustered, RUN_TS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 4 and text.count("partial_count(1)") == 2
    assert "SortMergeJoin" in text and "partial_collect_list" in text and "BroadcastExchange" not in text


def test_lookups_reach_the_files(spark):
    golden = lake(spark, SF).tables["golden_clientes"]
    text = plan(search.detail_rows(golden, "x"))
    assert "EqualTo(id_golden,x)" in text
    text = plan(search.search_matches(golden, doc="1-2").select("id_golden"))
    assert "EqualTo(cpf_cnpj,12)" in text
    assert re.search(r"ReadSchema: struct<id_golden:string,cpf_cnpj:string>", text)


def test_first_pages_are_a_distributed_top_n(spark):
    golden = lake(spark, SF).tables["golden_clientes"]
    assert "TakeOrderedAndProject" in plan(search.search(golden, q="a").data)


@pytest.mark.parametrize("kind", ["clientes", "fornecedores"])
def test_code_of_a_derived_line_can_be_compiled(spark, kind):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        registries.derive_registry(spark, SF, "empresa_d", kind).explain("codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    # the JVM interprets longer methods
    assert sizes and max(sizes) < 8000


def test_source_rows_are_dealt_by_their_number(spark, monkeypatch):
    whole = {key: frame.collect() for key, frame in registries.derive_all(spark, SF).items()}
    monkeypatch.setattr(registries, "TASK_ROWS", 100)
    for key, frame in registries.derive_all(spark, SF).items():
        assert sorted(map(str, frame.collect())) == sorted(map(str, whole[key]))
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    dealt = registries.read_table(spark, SF, "lineitem")
    assert dealt.rdd.getNumPartitions() == -(-lines // 100)
    assert dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < lines / 5
