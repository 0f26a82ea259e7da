"""Spellings a hand-kept spreadsheet would have: used to test the cleaning, on any table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldenrec.functions.documents import deaccent, mask_doc
from goldenrec.functions.normalize import as_column


def phone_spelling(phone: Column | str, variant: Column) -> Column:
    """One of four notations of a 13-digit phone; the last one has no area code."""
    phone = as_column(phone)
    area = F.substring(phone, 3, 2)
    digits = F.substring(phone, 5, 9)
    blocks = F.concat_ws(" ", *[F.substring(phone, start, 3) for start in (5, 8, 11)])
    return (
        F.when(variant % 4 == 0, F.concat_ws(".", area, digits))
        .when(variant % 4 == 1, F.concat(F.lit("tel +55"), area, digits))
        .when(variant % 4 == 2, F.concat_ws("/", area, blocks))
        .otherwise(blocks)
    )


def text_spelling(text: Column | str, percent: Column) -> Column:
    """As it is, in small letters, with doubled spaces, or without accents and spaced, a quarter each."""
    text = as_column(text)
    return (
        F.when(percent < 25, text)
        .when(percent < 50, F.lower(text))
        .when(percent < 75, F.replace(text, F.lit(" "), F.lit("  ")))
        .otherwise(F.concat(F.lit(" "), deaccent(text), F.lit("   ")))
    )


def doc_spelling(doc: Column | str, percent: Column, unmasked_below: int) -> Column:
    return F.when(percent < unmasked_below, as_column(doc)).otherwise(mask_doc(doc))


def blank_some(text: Column | str, percent: Column, blank_below: int) -> Column:
    return F.when(percent < blank_below, "").otherwise(as_column(text))


def repeat_rows(frame, percent: Column, below: int):
    """Every row once, and those with ``percent`` under ``below`` a second time."""
    times = F.when(percent < below, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return frame.withColumn("_copy", F.explode(times)).drop("_copy")
