"""From raw documents to a training mix: language, lines, near copies, benchmark, source weights."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenrec.llm.columns import apart
from goldenrec.llm.decontam import find_contamination
from goldenrec.llm.language import UNKNOWN, identify, learn
from goldenrec.llm.line_dedup import dedup_lines
from goldenrec.llm.mixing import mix
from goldenrec.llm.near_dup import near_duplicates
from goldenrec.session import run_folder

# A text whose words agree less than this on any language is no prose in one of the languages known.
LANGUAGE_SCORE = 0.4
# A line of three words, as the line operator counts them.
_WORD, _BETWEEN = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+", r"[^0-9A-Za-z\x{80}-\x{10FFFF}\n]+"
FULL_LINE = _BETWEEN.join([_WORD] * 3)
# What is left of a document that lost lines are scraps if it has no full line and at most this share of the letters.
SCRAPS = 0.1


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that the labelled ones teach.

    NULL texts and texts without letters go; so does all if no label is known.
    """
    given, restored = apart(docs, ("held_out", "lang_pred", "score"))
    labelled = identify(given, learn(docs))
    clear = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LANGUAGE_SCORE)
    return restored(labelled.where(clear).select(given.columns))


def _letters(text: Column) -> Column:
    """Characters of all words: scripts without spaces count as much as others."""
    return F.length(F.regexp_replace(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", ""))


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document has.

    One that lost lines and has none of three words and at most SCRAPS of its letters left was a copy: its scraps go too.
    """
    given, restored = apart(docs, ("n_lines", "n_removed", "_letters"))
    rest = dedup_lines(given.withColumn("_letters", _letters(F.col("text"))))
    if "n_chars" in docs.columns:
        rest = rest.withColumn("n_chars", F.length("text").cast("long"))
    own = _letters(F.col("text")) > F.col("_letters") * SCRAPS
    return restored(rest.where((F.col("n_removed") == 0) | F.col("text").rlike(FULL_LINE) | own).select(given.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    Of rows that repeat doc_id and text one stays.
    """
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_version"))
    given, restored = apart(docs, ("_id", "_version"))
    joined = given.join(kept.distinct(), same)
    return restored(joined.dropDuplicates(["_id", "_version"]).select(given.columns))


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    given, restored = apart(docs, ("n_words", "n_hit", "items", "hits"))
    return restored(find_contamination(given, items).where("n_hit = 0").select(given.columns))


def weighted_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words taken of each."""
    return mix(docs).where("taken > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("line dedup", unique_lines),
    ("near duplicates", near_copies),
    ("decontamination", clean_of_benchmark),
    ("source mix", weighted_mix),
]

# The language model and the SimHash stages have no SQL form; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{run_folder(spark)}/corpus-{uuid.uuid4()}"
    for place, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{place}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
