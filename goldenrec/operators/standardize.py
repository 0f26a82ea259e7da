"""Bronze rows of each source -> the common silver schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.functions import normalize as N
from goldenrec.operators.latest import latest_per_key
from goldenrec.schemas import SILVER

_META = ("_source", "_ingested_at", "_batch_id")


@dataclass(frozen=True)
class SourceSpec:
    """How one source fills the silver schema.

    ``raw`` names the text columns that feed document, phone, e-mail and name; ``columns`` holds
    the targets that need an expression of their own and may use the prepared ``_doc``.
    """

    source: str
    registry: str
    keys: tuple[str, ...]
    extras: Mapping[str, str]
    name: str
    email: str
    phone: str
    doc: str | None
    columns: Callable[[bool], Mapping[str, Column]]

    @property
    def label(self) -> str:
        return "cliente" if self.registry == "clientes" else "fornecedor"

    @property
    def model(self) -> str:
        return f"stg_{self.source}_{self.registry}"


def _relational(registry: str) -> SourceSpec:
    return SourceSpec(
        source="empresa_a",
        registry=registry,
        keys=("id",),
        name="nome_razao_social",
        email="email",
        phone="telefone_principal",
        doc="cpf_cnpj",
        extras={
            name: name
            for name in (
                "endereco_rua",
                "endereco_numero",
                "endereco_bairro",
                "endereco_cep",
                "data_cadastro",
                "status",
                "updated_at",
            )
        },
        columns=lambda strict: {
            "id_unicad": N.record_id("empresa_a", "id"),
            "id_origem": F.col("id").cast("string"),
            "tipo_pessoa": F.coalesce("tipo_pessoa", N.person_type("_doc")),
            "cidade": N.clean_name("endereco_cidade"),
            "uf": N.clean_uf("endereco_uf"),
        },
    )


_CRM = SourceSpec(
    source="empresa_b",
    registry="clientes",
    keys=("client_id",),
    name="full_name",
    email="email",
    phone="phone",
    doc=None,
    extras={
        name: name
        for name in (
            "instagram_handle",
            "twitter_handle",
            "facebook_url",
            "preferred_channel",
            "signup_date",
            "last_active",
        )
    },
    columns=lambda strict: {
        "id_unicad": N.record_id("empresa_b", "client_id"),
        "id_origem": F.col("client_id").cast("string"),
        "tipo_pessoa": F.lit("PF"),
        # no document at all counts as not valid here, not as unknown
        "cpf_cnpj_valido": F.lit(False),
        "cidade": F.lit(None),
        "uf": F.lit(None),
    },
)

_DOCUMENTS = SourceSpec(
    source="empresa_c",
    registry="fornecedores",
    keys=("_id",),
    name="razao_social",
    email="contato_email",
    phone="contato_telefone",
    doc="cnpj",
    extras={
        name: name
        for name in (
            "contato_nome",
            "categorias",
            "certificacoes",
            "avaliacao_media",
            "data_cadastro",
            "dados_bancarios",
            "observacoes",
            "endereco",
        )
    },
    columns=lambda strict: {
        "id_unicad": N.record_id("empresa_c", "_id"),
        "id_origem": F.col("_id"),
        "tipo_pessoa": F.lit("PJ"),
        "cidade": N.clean_name(N.json_text("endereco", "cidade", strict)),
        "uf": N.clean_uf(N.json_text("endereco", "uf", strict)),
    },
)


def _legacy_csv(registry: str, tag: str) -> SourceSpec:
    return SourceSpec(
        source="empresa_d",
        registry=registry,
        keys=("Documento", "Nome"),
        name="Nome",
        email="Email",
        phone="Fone",
        doc="Documento",
        extras={
            "endereco_original": "Endereco",
            "observacoes": "Obs",
            "documento_bruto": "Documento",
            "telefone_bruto": "Fone",
        },
        columns=lambda strict: {
            # no natural key: document plus the name as written
            "id_unicad": N.record_id(
                tag, F.concat(F.col("_doc"), F.lit("|"), F.coalesce("Nome", F.lit("")))
            ),
            "id_origem": F.col("_doc"),
            "tipo_pessoa": N.person_type("_doc"),
            "cidade": N.clean_name(N.address_city("Endereco")),
            "uf": N.clean_uf(N.address_uf("Endereco")),
        },
    )


_API = SourceSpec(
    source="empresa_e",
    registry="clientes",
    keys=("id",),
    name="name",
    email="email",
    phone="phone",
    doc="document",
    extras={name: name for name in ("type", "tags", "created_at", "updated_at", "address")},
    columns=lambda strict: {
        "id_unicad": N.record_id("empresa_e", "id"),
        "id_origem": F.col("id"),
        "tipo_pessoa": F.when(F.col("type") == "business", "PJ").otherwise("PF"),
        "cidade": N.clean_name(N.json_text("address", "city", strict)),
        "uf": N.clean_uf(N.json_text("address", "state", strict)),
    },
)

SPECS: dict[tuple[str, str], SourceSpec] = {
    (spec.source, spec.registry): spec
    for spec in (
        _relational("clientes"),
        _relational("fornecedores"),
        _CRM,
        _DOCUMENTS,
        _legacy_csv("clientes", "empresa_d_cli"),
        _legacy_csv("fornecedores", "empresa_d_forn"),
        _API,
    )
}


def run_stamp(run_ts: datetime | None) -> Column:
    """Processing time: one given instant, or the start of the query."""
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def standardize(
    bronze: DataFrame,
    spec: SourceSpec,
    run_ts: datetime | None = None,
    strict: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Newest bronze row per source key, normalised to the silver columns, with the columns ``keep`` behind them.

    ``strict`` fails on malformed JSON; otherwise such a row keeps its text in
    ``atributos_extras`` and has no city and state.
    """
    return normalised(latest_per_key(bronze, list(spec.keys)), spec, run_ts, strict, keep)


def normalised(
    newest: DataFrame,
    spec: SourceSpec,
    run_ts: datetime | None = None,
    strict: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``standardize`` for rows that are the newest of their key already."""
    doc = N.clean_doc(spec.doc) if spec.doc else F.lit(None).cast("string")
    prepared = newest.withColumns({"_doc": doc, "_phone": N.digits(spec.phone)})
    target: dict[str, Column] = {
        "fonte": F.lit(spec.source),
        "tipo_cadastro": F.lit(spec.label),
        "nome_razao_social": N.clean_name(spec.name),
        "cpf_cnpj": F.col("_doc"),
        "cpf_cnpj_kind": N.doc_kind("_doc"),
        "cpf_cnpj_valido": N.doc_valid("_doc"),
        "email": N.clean_email(spec.email),
        "telefone_principal": N.phone_from_digits("_phone"),
        "atributos_extras": N.pack_json(
            *[F.col(old).alias(new) for new, old in spec.extras.items()]
        ),
        "_processed_at": run_stamp(run_ts),
        **{name: F.col(name) for name in _META},
        **spec.columns(strict),
    }
    return prepared.select(
        [target[column.name].cast(column.dataType).alias(column.name) for column in SILVER] + [F.col(name) for name in keep]
    )


def union_registry(parts: list[DataFrame]) -> DataFrame:
    """One registry over all its sources, matched by column name."""
    return reduce(DataFrame.unionByName, parts)
