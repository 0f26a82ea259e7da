"""The stages against their operators' definitions, on the small tables."""

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_their_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, docs.count()
    odd = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "12 34", "en", "s", 5)], docs.schema)
    copies = docs.orderBy("doc_id").limit(3).withColumn("doc_id", F.col("doc_id") + 10_000_000)
    docs = docs.unionByName(odd).unionByName(copies)
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF).cache()
        if name != "source mix":
            assert result.columns == names
        ids[name] = {r.doc_id for r in result.select("doc_id").collect()}
        docs = result
    assert not ids["language"] & {-1, -2} and len(ids["language"]) == before + 3
    assert not ids["near duplicates"] & {r + 10_000_000 for r in range(3)}
    assert len(ids["decontamination"]) < len(ids["near duplicates"])
    assert docs.where("taken <= 0 or taken > 3 * size").count() == 0


def test_columns_called_like_results_keep_their_values(spark):
    names = ["_id", "_version", "version", "_gone", "_hit", "score", "lang_pred", "n_hit", "hits", "Items", "n_removed", "_text"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60)
    docs = docs.withColumns({name: F.concat(F.lit(name), "doc_id") for name in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        rows = docs.collect()
        assert len(rows) > 30, name
        assert all(row[column] == f"{column}{row.doc_id}" for row in rows for column in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_a_shared_line_does_not_take_the_rest_along(spark):
    line, copied = "All rights reserved 2020", "one long line of words that is repeated elsewhere"
    texts = [
        line + "\n" + copied,
        line + "\n" + "\n".join(f"term{i}" for i in range(30)),
        line + "\n" + "这是一个没有空格的句子其中的文字只在这里出现",
        line + "\n" + copied + "\nEnd",
    ]
    rows = [(i, text, "en", "s", len(text)) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r.text for r in corpus_pipeline.unique_lines(spark, docs, SF).collect()}
    assert found == {0: texts[0], 1: texts[1].split("\n", 1)[1], 2: texts[2].split("\n", 1)[1]}


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.count() > 0 and "taken" in found.columns
