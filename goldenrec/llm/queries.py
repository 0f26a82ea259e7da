"""Registered queries of the training-data operators, on the whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenrec.llm.chat import Tree, build_tree, read_conversations
from goldenrec.llm.decontam import find_contamination
from goldenrec.llm.fill_middle import fill_in_middle, restore
from goldenrec.llm.language import identify, learn
from goldenrec.llm.line_dedup import dedup_lines
from goldenrec.llm.mixing import mix
from goldenrec.llm.near_dup import near_duplicates
from goldenrec.llm.neighbours import nearest
from goldenrec.llm.phrases import collocations
from goldenrec.llm.secrets import BASE, find_secrets, spelled
from goldenrec.llm.substrings import remove_repeats
from goldenrec.llm.vector_dup import near_vectors
from goldenrec.llm.warc import read_archive, write_archive
from goldenrec.session import run_folder, stage


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda span: span["rank"] < len(BASE))

    def count(rank: int):
        return F.size(F.filter("spans", lambda span: span["rank"] == rank)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
    )


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = find_contamination(documents, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return identify(docs.select("doc_id", "text"), learn(docs)).drop("text")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).drop("version")


def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))


def op7_web_archive(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{run_folder(spark)}/warc-{uuid.uuid4()}"
    write_archive(table(spark, folder, "pages"), path)
    records = read_archive(spark, path)
    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op8_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tree = build_tree(conversations.unionByName(extra))
    # written and read again: the result comes from the output alone
    return read_conversations(Tree(stage(tree.nodes, "chat-nodes"), stage(tree.paths, "chat-paths")))


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = fill_in_middle(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        F.length("prefix").cast("long").alias("prefix_chars"),
        F.length("middle").cast("long").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op12_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decontamination": op2_decontamination,
    "op3_language": op3_language,
    "op4_line_dedup": op4_line_dedup,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_source_mix": op6_source_mix,
    "op7_web_archive": op7_web_archive,
    "op8_nearest_vectors": op8_nearest_vectors,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_chat_format": op10_chat_format,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_near_vectors": op12_near_vectors,
    "op13_phrases": op13_phrases,
}
