"""Column contracts of every layer, as Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

_STR = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SILVER = _struct(
    id_unicad=_STR,
    fonte=_STR,
    id_origem=_STR,
    tipo_cadastro=_STR,
    tipo_pessoa=_STR,
    nome_razao_social=_STR,
    cpf_cnpj=_STR,
    cpf_cnpj_kind=_STR,
    cpf_cnpj_valido=T.BooleanType(),
    email=_STR,
    telefone_principal=_STR,
    cidade=_STR,
    uf=_STR,
    atributos_extras=_STR,
    _source=_STR,
    _ingested_at=_STR,
    _batch_id=_STR,
    _processed_at=T.TimestampType(),
)

CLUSTER = T.StructType(
    SILVER.fields + [T.StructField("cluster_key", _STR), T.StructField("match_method", _STR)]
)

ADDRESS = _struct(cidade=_STR, uf=_STR, fonte=_STR)
ATTRIBUTES = _struct(fonte=_STR, atributos=_STR)

GOLDEN = _struct(
    id_golden=_STR,
    cluster_key=_STR,
    tipo_pessoa=_STR,
    nome_razao_social=_STR,
    cpf_cnpj=_STR,
    cpf_cnpj_kind=_STR,
    emails=T.ArrayType(_STR),
    telefones=T.ArrayType(_STR),
    enderecos=T.ArrayType(ADDRESS),
    fontes=T.ArrayType(_STR),
    total_fontes=T.LongType(),
    metodos_match=T.ArrayType(_STR),
    ids_origem=T.MapType(_STR, _STR),
    atributos_por_fonte=T.ArrayType(ATTRIBUTES),
    score_completude=T.DoubleType(),
    primeira_aparicao=_STR,
    ultima_atualizacao=_STR,
    versao=T.IntegerType(),
    _processed_at=T.TimestampType(),
)

METRICS = _struct(
    tipo_cadastro=_STR,
    fonte=_STR,
    registros_prata=T.LongType(),
    com_doc_valido=T.LongType(),
    com_email=T.LongType(),
    com_telefone=T.LongType(),
    com_cidade=T.LongType(),
    com_uf=T.LongType(),
    pct_doc_valido=T.DoubleType(),
    pct_email=T.DoubleType(),
    pct_telefone=T.DoubleType(),
    pct_cidade=T.DoubleType(),
    score_completude_medio=T.DoubleType(),
    fontes_medias_por_registro=T.DoubleType(),
    registros_multi_fonte=T.LongType(),
    registros_ouro=T.LongType(),
    taxa_deduplicacao=T.DoubleType(),
)

_META = [T.StructField(name, _STR) for name in ("_source", "_ingested_at", "_batch_id")]


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, _STR) for name in names]


# Bronze columns per (source, registry type); dates are ISO strings, nested values JSON text.
_A = T.StructType(
    [T.StructField("id", T.LongType())]
    + _strings(
        "tipo_pessoa",
        "nome_razao_social",
        "cpf_cnpj",
        "endereco_rua",
        "endereco_numero",
        "endereco_bairro",
        "endereco_cidade",
        "endereco_uf",
        "endereco_cep",
        "telefone_principal",
        "email",
        "data_cadastro",
        "status",
        "updated_at",
    )
    + _META
)
_B = T.StructType(
    [T.StructField("client_id", T.LongType())]
    + _strings(
        "full_name",
        "email",
        "phone",
        "instagram_handle",
        "twitter_handle",
        "facebook_url",
        "preferred_channel",
        "signup_date",
        "last_active",
    )
    + _META
)
_C = T.StructType(
    _strings(
        "_id", "razao_social", "cnpj", "contato_nome", "contato_telefone", "contato_email", "categorias"
    )
    + [T.StructField("avaliacao_media", T.DoubleType())]
    + _strings("data_cadastro", "certificacoes", "endereco", "dados_bancarios", "observacoes")
    + _META
)
CSV_COLUMNS = ("Nome", "Documento", "Fone", "Email", "Endereco", "Obs")
_D = T.StructType(_strings(*CSV_COLUMNS) + _META)
_E = T.StructType(
    _strings(
        "id", "type", "name", "document", "email", "phone", "address", "tags", "created_at", "updated_at"
    )
    + _META
)

BRONZE: dict[tuple[str, str], T.StructType] = {
    ("empresa_a", "clientes"): _A,
    ("empresa_a", "fornecedores"): _A,
    ("empresa_b", "clientes"): _B,
    ("empresa_c", "fornecedores"): _C,
    ("empresa_d", "clientes"): _D,
    ("empresa_d", "fornecedores"): _D,
    ("empresa_e", "clientes"): _E,
}
