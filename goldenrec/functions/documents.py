"""Document masks, check digits and accent-free text."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldenrec.functions.normalize import CNPJ_LENGTH, CPF_LENGTH, as_column

# Mod-11 weights. The second digit also counts the first one, with weight 2.
CPF_FIRST = (10, 9, 8, 7, 6, 5, 4, 3, 2)
CPF_SECOND = (11, 10, 9, 8, 7, 6, 5, 4, 3)
CNPJ_FIRST = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
CNPJ_SECOND = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3)
LAST_WEIGHT = 2


def mask_doc(doc: Column | str) -> Column:
    """``000.000.000-00`` or ``00.000.000/0000-00``; other lengths come back unchanged."""
    doc = as_column(doc)
    size = F.length(doc)
    cpf = F.regexp_replace(doc, r"\A(.{3})(.{3})(.{3})(.{2})\z", "$1.$2.$3-$4")
    cnpj = F.regexp_replace(doc, r"\A(.{2})(.{3})(.{3})(.{4})(.{2})\z", "$1.$2.$3/$4-$5")
    return F.when(size == CPF_LENGTH, cpf).when(size == CNPJ_LENGTH, cnpj).otherwise(doc)


def _weighted(digits: Column, weights: Sequence[int]) -> Column:
    """Dot product of the leading digits with the weights."""
    fixed = F.array(*[F.lit(w) for w in weights])
    terms = F.zip_with(F.slice(digits, 1, len(weights)), fixed, lambda digit, weight: digit * weight)
    return F.aggregate(terms, F.lit(0), lambda total, term: total + term)


def _mod11(total: Column) -> Column:
    """0 for remainders 0 and 1, else 11 minus the remainder."""
    return (11 - total % 11) % 11 % 10


def _check_pair(digits: Column, first: Sequence[int], second: Sequence[int]) -> Column:
    """Both check digits of a base, as one number 0..99."""

    def both(sums: Column) -> Column:
        one = _mod11(sums["first"])
        return one * 10 + _mod11(sums["second"] + one * LAST_WEIGHT)

    sums = F.struct(_weighted(digits, first).alias("first"), _weighted(digits, second).alias("second"))
    # an array of one, so that the sums are computed once and named
    return F.get(F.transform(F.array(sums), both), F.lit(0))


def expected_check_digits(doc: Column | str) -> Column:
    """The two check digits the leading digits call for; NULL for texts that are not a document."""
    doc = as_column(doc)
    # digits become an array once; everything behind it works on small arrays, not on generated code per digit
    digits = F.transform(F.split(doc, ""), lambda sign: F.ascii(sign) - ord("0"))
    pair = F.when(doc.rlike(r"\A[0-9]{11}\z"), _check_pair(digits, CPF_FIRST, CPF_SECOND)).when(
        doc.rlike(r"\A[0-9]{14}\z"), _check_pair(digits, CNPJ_FIRST, CNPJ_SECOND)
    )
    return F.lpad(pair.cast("string"), 2, "0")


def complete_doc(base: Column | str) -> Column:
    """9 or 12 digits with their two check digits appended; NULL for other texts."""
    base = as_column(base)
    return F.concat(base, expected_check_digits(F.concat(base, F.lit("00"))))


def check_digits_ok(doc: Column | str, expected: Column | str | None = None) -> Column:
    """True when the last two digits are the expected ones; NULL for NULL, false for other lengths.

    ``expected`` is a column that holds ``expected_check_digits`` already.
    """
    doc = as_column(doc)
    good = F.right(doc, F.lit(2)) == (expected_check_digits(doc) if expected is None else as_column(expected))
    return F.when(doc.isNotNull(), F.coalesce(good, F.lit(False)))


def strip_punct(value: Column | str) -> Column:
    return F.regexp_replace(as_column(value), "[^0-9]", "")


def _accent_table() -> tuple[str, str]:
    """Every character whose canonical decomposition is one base character plus marks."""
    source, target = [], []
    for code in (c for c in range(0xC0, 0x30000) if not 0xD800 <= c < 0xE000):
        letter = chr(code)
        base = [c for c in unicodedata.normalize("NFD", letter) if unicodedata.category(c) != "Mn"]
        if len(base) == 1 and base[0] != letter:
            source.append(letter)
            target.append(base[0])
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_table()


def deaccent(value: Column | str) -> Column:
    """Letters without their accents; marks that stand alone are dropped."""
    plain = F.translate(as_column(value), _ACCENTED, _PLAIN)
    return F.regexp_replace(plain, r"\p{Mn}+", "")
