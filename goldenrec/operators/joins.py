"""Joins whose many side may have hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shuffled_alone(frame: DataFrame, key: str) -> DataFrame:
    """Rows with a text ``key``, which is rebuilt so that a join by it shuffles this side anew.

    Adaptive execution splits a hot partition of a join only when both sides come straight from a
    shuffle of that join. The result of an aggregation or window by the key keeps their
    partitioning and would rule the split out; it has one row per key, so shuffling it is cheap
    next to a task that holds a third of the other side.
    """
    # never NULL, so the join adds no null test of this expression to the scans below
    rebuilt = F.concat(F.coalesce(F.col(key), F.lit("")), F.lit(""))
    return frame.where(F.col(key).isNotNull()).withColumn(key, rebuilt)
