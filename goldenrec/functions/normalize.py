"""Normalisers for documents, phones, e-mails, names, addresses and ids, as Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Accepted document lengths, phone lengths and text patterns.
CPF_LENGTH = 11
CNPJ_LENGTH = 14
LOCAL_PHONE_LENGTHS = (10, 11)
COUNTRY_PHONE_LENGTHS = (12, 13)
COUNTRY_CODE = "55"
EMAIL_PATTERN = r"\A[^@\s]+@[^@\s]+\.[^@\s]+\z"
ADDRESS_UF_PATTERN = r"-\s*([A-Za-z]{2})\s*\z"
ADDRESS_CITY_PATTERN = r",\s*([^,]+?)\s*-\s*[A-Za-z]{2}\s*\z"
# What trimming takes off: every Unicode space separator, no-break space included, but not tabs.
BLANKS = "".join(chr(c) for c in range(0x10000) if unicodedata.category(chr(c)) == "Zs")


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: Column | str) -> Column:
    return F.btrim(as_column(value), F.lit(BLANKS))


def digits(value: Column | str) -> Column:
    return F.regexp_replace(as_column(value), "[^0-9]", "")


def clean_doc(value: Column | str) -> Column:
    """Digits only; NULL when none are left."""
    return F.nullif(digits(value), F.lit(""))


def doc_kind(doc: Column | str) -> Column:
    size = F.length(as_column(doc))
    return F.when(size == CPF_LENGTH, "CPF").when(size == CNPJ_LENGTH, "CNPJ")


def person_type(doc: Column | str) -> Column:
    size = F.length(as_column(doc))
    return F.when(size == CPF_LENGTH, "PF").when(size == CNPJ_LENGTH, "PJ")


def doc_valid(doc: Column | str) -> Column:
    """Legal length and not one digit repeated. NULL in, NULL out; check digits are not looked at."""
    doc = as_column(doc)
    size = F.length(doc)
    return size.isin(CPF_LENGTH, CNPJ_LENGTH) & (doc != F.repeat(F.substring(doc, 1, 1), size))


def phone_from_digits(number: Column | str) -> Column:
    number = as_column(number)
    size = F.length(number)
    return F.when(
        size.isin(*LOCAL_PHONE_LENGTHS), F.concat(F.lit("+" + COUNTRY_CODE), number)
    ).when(size.isin(*COUNTRY_PHONE_LENGTHS), F.concat(F.lit("+"), number))


def to_e164(value: Column | str) -> Column:
    """10-11 digits get the country code, 12-13 are taken as complete, all else is NULL."""
    return phone_from_digits(digits(value))


def clean_email(value: Column | str) -> Column:
    email = F.lower(trimmed(value))
    return F.when(email.rlike(EMAIL_PATTERN), email)


def clean_name(value: Column | str) -> Column:
    """Outer blanks off, inner whitespace runs to one blank; letter case is left as it is."""
    return F.nullif(F.regexp_replace(trimmed(value), r"\s+", " "), F.lit(""))


def clean_uf(value: Column | str) -> Column:
    uf = trimmed(value)
    return F.when(F.length(uf) == 2, F.upper(uf))


def record_id(tag: str, key: Column | str) -> Column:
    """md5 of ``tag|key``; NULL when the key is NULL."""
    return F.md5(F.concat(F.lit(tag + "|"), as_column(key).cast("string")))


def address_uf(address: Column | str) -> Column:
    """Two letters after the last hyphen; '' when the text does not end that way."""
    return F.regexp_extract(as_column(address), ADDRESS_UF_PATTERN, 1)


def address_city(address: Column | str) -> Column:
    """Text between the last comma and the closing ``- XX``; '' when absent."""
    return F.regexp_extract(as_column(address), ADDRESS_CITY_PATTERN, 1)


def json_text(document: Column | str, key: str, strict: bool = False) -> Column:
    """Text of a top-level key; missing and JSON null give NULL.

    Malformed JSON gives NULL, or fails the query when ``strict``.
    """
    document = as_column(document)
    value = F.get_json_object(document, f"$.{key}")
    if not strict:
        return F.when(F.try_parse_json(document).isNotNull(), value)
    return F.when(F.parse_json(document).isNotNull(), value)


def pack_json(*columns: Column) -> Column:
    """JSON object text of the given columns, NULL values kept as explicit nulls."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


_TRIMMED = "btrim(s, '" + "".join(f"\\u{ord(c):04x}" for c in BLANKS) + "')"

# The same normalisers for SQL users: name -> (parameters, result type, expression).
_SQL_FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "clean_doc": ("s STRING", "STRING", "nullif(regexp_replace(s, '[^0-9]', ''), '')"),
    "doc_kind": (
        "d STRING",
        "STRING",
        "case length(d) when 11 then 'CPF' when 14 then 'CNPJ' end",
    ),
    "doc_valid": (
        "d STRING",
        "BOOLEAN",
        "length(d) in (11, 14) and d <> repeat(left(d, 1), length(d))",
    ),
    "to_e164": (
        "s STRING",
        "STRING",
        "case when length(regexp_replace(s, '[^0-9]', '')) between 10 and 11 "
        "then concat('+55', regexp_replace(s, '[^0-9]', '')) "
        "when length(regexp_replace(s, '[^0-9]', '')) between 12 and 13 "
        "then concat('+', regexp_replace(s, '[^0-9]', '')) end",
    ),
    "clean_email": (
        "s STRING",
        "STRING",
        f"case when lower({_TRIMMED}) rlike r'{EMAIL_PATTERN}' then lower({_TRIMMED}) end",
    ),
    "clean_nome": (
        "s STRING",
        "STRING",
        rf"nullif(regexp_replace({_TRIMMED}, r'\s+', ' '), '')",
    ),
    "clean_uf": (
        "s STRING",
        "STRING",
        f"case when length({_TRIMMED}) = 2 then upper({_TRIMMED}) end",
    ),
    "id_unicad": ("tag STRING, id STRING", "STRING", "md5(concat(tag, '|', id))"),
    "tipo_pessoa_from_doc": (
        "d STRING",
        "STRING",
        "case length(d) when 11 then 'PF' when 14 then 'PJ' end",
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the normalisers callable from SQL; they stay plain Catalyst expressions."""
    for name, (parameters, result, body) in _SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}"
        )
    return list(_SQL_FUNCTIONS)
