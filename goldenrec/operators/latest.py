"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    frame: DataFrame,
    keys: list[str],
    order: str = "_ingested_at",
    then: tuple[str, ...] = ("_batch_id",),
) -> DataFrame:
    """Row with the greatest ``order`` per key; NULL keys form one group.

    Ties go to the greatest ``then`` columns and after those to the greatest payload, column by
    column in name order, so every run keeps the same row. Spark drops all but the best row of a
    key inside each map task, so a key that holds most rows costs one row per task in the shuffle.
    """
    first = [order, *(name for name in then if name in frame.columns)]
    payload = sorted(name for name in frame.columns if name not in (*keys, *first))
    best_first = [F.col(name).desc_nulls_last() for name in first + payload]
    window = Window.partitionBy(*keys).orderBy(*best_first)
    return (
        frame.withColumn("_place", F.row_number().over(window))
        .where(F.col("_place") == 1)
        .drop("_place")
    )
