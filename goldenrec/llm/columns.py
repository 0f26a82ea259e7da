"""Column names of an input that an operator needs for itself."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame


def text_place(names: Sequence[str]) -> int:
    """Which of the columns ``names`` Spark means by ``text``."""
    return names.index("text") if "text" in names else [name.lower() for name in names].index("text")


def apart(frame: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``frame`` with columns called like one of ``names`` renamed, and the way back for results.

    Names compare without case, as Spark resolves them.
    """
    wanted = {name.lower() for name in names}
    have = {column.lower() for column in frame.columns}
    renamed = {}
    for column in frame.columns:
        if column.lower() in wanted:
            fresh = f"{column}_given"
            while fresh.lower() in have | wanted:
                fresh += "_"
            have.add(fresh.lower())
            renamed[column] = fresh
    back = {fresh: column for column, fresh in renamed.items()}
    return frame.withColumnsRenamed(renamed), lambda result: result.withColumnsRenamed(back)
