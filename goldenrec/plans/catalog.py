"""The lake as SQL views, and a runner for SQL text."""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from goldenrec.functions.normalize import register_sql_functions
from goldenrec.plans.pipeline import open_lake, read_all_bronze
from goldenrec.sources.readers import bronze_all


def register_views(spark: SparkSession, base: str) -> list[str]:
    """``bronze_all`` and one view per stored model, plus the normalisers as SQL functions."""
    views = {
        "bronze_all": bronze_all(list(read_all_bronze(spark, base, every_column=True).values())),
        **open_lake(spark, base),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    register_sql_functions(spark)
    return list(views)


def run_sql(spark: SparkSession, text: str) -> DataFrame | None:
    """Result of one statement; a failing one prints its error and gives None."""
    try:
        return spark.sql(text)
    except PySparkException as error:
        print(f"Error: {error}", file=sys.stderr)
        return None


def run_sql_file(spark: SparkSession, path: str) -> DataFrame | None:
    return run_sql(spark, Path(path).read_text(encoding="utf-8"))
