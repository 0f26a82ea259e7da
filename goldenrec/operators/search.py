"""Search and read functions over the golden tables."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from goldenrec.operators.paging import page_of

# Page sizes.
DEFAULT_PER_PAGE = 25
MAX_PER_PAGE = 100

SUMMARY = (
    "id_golden",
    "nome_razao_social",
    "cpf_cnpj",
    "cpf_cnpj_kind",
    "tipo_pessoa",
    "emails",
    "telefones",
    "enderecos",
    "fontes",
    "total_fontes",
    "score_completude",
)
DETAIL = SUMMARY + (
    "metodos_match",
    "ids_origem",
    "atributos_por_fonte",
    "primeira_aparicao",
    "ultima_atualizacao",
    "versao",
)


class Page(NamedTuple):
    """``data`` holds at most ``per_page`` summaries in rank order."""

    total: int
    page: int
    per_page: int
    has_next: bool
    data: DataFrame


def only_digits(value: str | None) -> str | None:
    """Digits of a search parameter; None when there are none."""
    return re.sub("[^0-9]", "", value or "") or None


def _contains(column: Column, text: str) -> Column:
    """Case-blind containment; ``%`` and ``_`` in the text are wildcards, a backslash is itself."""
    return column.ilike("%" + text.replace("\\", "\\\\") + "%")


def _scalar_filters(q: str | None, doc: str | None) -> list[Column]:
    filters = []
    if q:
        filters.append(_contains(F.col("nome_razao_social"), q))
    if number := only_digits(doc):
        filters.append(F.col("cpf_cnpj") == number)
    return filters


def _some(column: str, test) -> Column:
    """Some entry of a list passes; no list means no."""
    return F.coalesce(F.exists(column, test), F.lit(False))


def search_matches(
    golden: DataFrame,
    *,
    q: str | None = None,
    doc: str | None = None,
    email: str | None = None,
    telefone: str | None = None,
    cidade: str | None = None,
    uf: str | None = None,
) -> DataFrame:
    """Golden rows that pass every filter that is set.

    Empty filters, and document or phone texts without any digit, do not apply.
    """
    filters = _scalar_filters(q, doc)
    if email:
        filters.append(_some("emails", lambda entry: _contains(entry, email.lower())))
    if number := only_digits(telefone):
        filters.append(_some("telefones", lambda entry: entry.contains(number)))
    if cidade:
        filters.append(_some("enderecos", lambda entry: _contains(entry["cidade"], cidade)))
    if uf:
        filters.append(_some("enderecos", lambda entry: entry["uf"] == uf.upper()))
    return golden.where(reduce(and_, filters)) if filters else golden


def check_page(page: int, per_page: int, uf: str | None) -> None:
    if page < 1:
        raise ValueError("page starts at 1")
    if not 1 <= per_page <= MAX_PER_PAGE:
        raise ValueError(f"per_page must be between 1 and {MAX_PER_PAGE}")
    if uf is not None and len(uf) != 2:
        raise ValueError("uf must have 2 letters")


def present(golden: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Result columns with absent lists and maps shown as empty, and the two instants as timestamps."""

    def shown(name: str) -> Column:
        kind = golden.schema[name].dataType
        if kind.typeName() == "array":
            return F.coalesce(F.col(name), F.array().cast(kind)).alias(name)
        if kind.typeName() == "map":
            return F.coalesce(F.col(name), F.create_map().cast(kind)).alias(name)
        if name in ("primeira_aparicao", "ultima_atualizacao"):
            return F.col(name).cast("timestamp").alias(name)
        return F.col(name)

    return golden.select([shown(name) for name in columns])


RANKING = [("score_completude", True), ("nome_razao_social", False)]


def search(
    golden: DataFrame,
    *,
    page: int = 1,
    per_page: int = DEFAULT_PER_PAGE,
    **filters: str | None,
) -> Page:
    """One page of matching summaries, best score first, then by name (none last), then by id.

    Filters are those of ``search_matches``.
    """
    check_page(page, per_page, filters.get("uf") or None)
    matches = search_matches(golden, **filters)
    total = matches.count()
    rows = page_of(matches, page, per_page, "id_golden", RANKING)
    return Page(total, page, per_page, page * per_page < total, present(rows, SUMMARY))


def detail_rows(golden: DataFrame, id_golden: str) -> DataFrame:
    """The 17 detail columns of one golden record: one row, or none."""
    return present(golden.where(F.col("id_golden") == id_golden), DETAIL)


def detail(golden: DataFrame, id_golden: str) -> Row | None:
    return detail_rows(golden, id_golden).first()


def resolve_entity_rows(golden_c: DataFrame, golden_f: DataFrame, id_golden: str) -> DataFrame:
    """The record behind an id whose registry is unknown: customers first, then suppliers.

    A company that is both has the same id in both tables, and the customer is returned; see
    ``resolve_entity_all``.
    """
    found = resolve_entity_all(golden_c, golden_f, id_golden)
    order = F.when(F.col("registro") == "clientes", 0).otherwise(1)
    return found.orderBy(order).limit(1).drop("registro")


def resolve_entity(golden_c: DataFrame, golden_f: DataFrame, id_golden: str) -> Row | None:
    return resolve_entity_rows(golden_c, golden_f, id_golden).first()


def resolve_entity_all(golden_c: DataFrame, golden_f: DataFrame, id_golden: str) -> DataFrame:
    """Up to two rows, each with the registry it comes from."""
    customers = detail_rows(golden_c, id_golden).withColumn("registro", F.lit("clientes"))
    suppliers = detail_rows(golden_f, id_golden).withColumn("registro", F.lit("fornecedores"))
    return customers.unionByName(suppliers)


def health(golden_c: DataFrame, golden_f: DataFrame) -> DataFrame:
    """``status, clientes, fornecedores``: row counts of both golden tables in one job."""
    tagged = golden_c.select(F.lit(True).alias("customer")).unionAll(
        golden_f.select(F.lit(False).alias("customer"))
    )
    return tagged.agg(
        F.lit("ok").alias("status"),
        F.count_if("customer").alias("clientes"),
        F.count_if(~F.col("customer")).alias("fornecedores"),
    )


def list_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("tipo_cadastro", "fonte")
