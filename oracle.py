"""The registered queries as DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from goldenrec.schemas import BRONZE
from goldenrec.sources.registries import portable_text

CUSTOMERS = [
    ("empresa_a", "clientes"),
    ("empresa_b", "clientes"),
    ("empresa_d", "clientes"),
    ("empresa_e", "clientes"),
]
SUPPLIERS = [
    ("empresa_a", "fornecedores"),
    ("empresa_c", "fornecedores"),
    ("empresa_d", "fornecedores"),
]
META = ("_source", "_ingested_at", "_batch_id")


def doc(x: str) -> str:
    return f"nullif(regexp_replace({x}, '\\D', '', 'g'), '')"


def kind(d: str) -> str:
    return f"case when length({d}) = 11 then 'CPF' when length({d}) = 14 then 'CNPJ' end"


def person(d: str) -> str:
    return f"case when length({d}) = 11 then 'PF' when length({d}) = 14 then 'PJ' end"


def valid(d: str) -> str:
    return (
        f"(regexp_full_match({d}, '[0-9]{{11}}|[0-9]{{14}}') and {d} <> repeat({d}[1], length({d})))"
    )


def phone(x: str) -> str:
    n = f"regexp_replace({x}, '\\D', '', 'g')"
    return (
        f"case when regexp_full_match({n}, '[0-9]{{10,11}}') then '+55' || {n} "
        f"when regexp_full_match({n}, '[0-9]{{12,13}}') then '+' || {n} end"
    )


def email(x: str) -> str:
    e = f"lower(trim({x}))"
    return f"case when regexp_full_match({e}, '[^@[:space:]]+@[^@[:space:]]+\\.[^@[:space:]]+') then {e} end"


def name(x: str) -> str:
    return f"nullif(regexp_replace(trim({x}), '[[:space:]]+', ' ', 'g'), '')"


def uf(x: str) -> str:
    return f"case when length(trim({x})) = 2 then upper(trim({x})) end"


def address_uf(x: str) -> str:
    return f"regexp_extract({x}, '-[[:space:]]*([a-zA-Z][a-zA-Z])[[:space:]]*$', 1)"


def address_city(x: str) -> str:
    return f"regexp_extract({x}, ',[[:space:]]*([^,]+?)[[:space:]]*-[[:space:]]*[a-zA-Z][a-zA-Z][[:space:]]*$', 1)"


def packed(names: dict[str, str]) -> str:
    pairs = ", ".join(f"'{new}', {old}" for new, old in names.items())
    return f"cast(json_object({pairs}) as varchar)"


def same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def newest(rows: str, keys: list[str], columns: list[str], order: str = "_ingested_at", then=("_batch_id",)) -> str:
    first = [order, *then]
    rest = sorted(c for c in columns if c not in keys and c not in first)
    ranked = ", ".join(f'"{c}" desc nulls last' for c in first + rest)
    by = ", ".join(f'"{k}"' for k in keys)
    return (
        f"select * exclude (place) from (select *, row_number() over (partition by {by} "
        f"order by {ranked}) as place from ({rows}) r) where place = 1"
    )


def bronze(key: tuple[str, str]) -> str:
    return portable_text(*key)


def bronze_columns(key: tuple[str, str]) -> list[str]:
    return BRONZE[key].fieldNames()


KEYS = {"empresa_a": ["id"], "empresa_b": ["client_id"], "empresa_c": ["_id"], "empresa_d": ["Documento", "Nome"], "empresa_e": ["id"]}
NAMES = {"empresa_a": "nome_razao_social", "empresa_b": "full_name", "empresa_c": "razao_social", "empresa_d": "Nome", "empresa_e": "name"}
MAILS = {"empresa_a": "email", "empresa_b": "email", "empresa_c": "contato_email", "empresa_d": "Email", "empresa_e": "email"}
PHONES = {"empresa_a": "telefone_principal", "empresa_b": "phone", "empresa_c": "contato_telefone", "empresa_d": "Fone", "empresa_e": "phone"}
DOCS = {"empresa_a": "cpf_cnpj", "empresa_b": "null::varchar", "empresa_c": "cnpj", "empresa_d": "Documento", "empresa_e": "document"}
EXTRAS = {
    "empresa_a": same("endereco_rua", "endereco_numero", "endereco_bairro", "endereco_cep", "data_cadastro", "status", "updated_at"),
    "empresa_b": same("instagram_handle", "twitter_handle", "facebook_url", "preferred_channel", "signup_date", "last_active"),
    "empresa_c": same("contato_nome", "categorias", "certificacoes", "avaliacao_media", "data_cadastro", "dados_bancarios", "observacoes", "endereco"),
    "empresa_d": {"endereco_original": "Endereco", "observacoes": "Obs", "documento_bruto": "Documento", "telefone_bruto": "Fone"},
    "empresa_e": same("type", "tags", "created_at", "updated_at", "address"),
}
IDS = {
    "empresa_a": ("'empresa_a'", "cast(id as varchar)"),
    "empresa_b": ("'empresa_b'", "cast(client_id as varchar)"),
    "empresa_c": ("'empresa_c'", "_id"),
    "empresa_e": ("'empresa_e'", "id"),
}
PLACES = {
    "empresa_a": (name("endereco_cidade"), uf("endereco_uf")),
    "empresa_b": ("null::varchar", "null::varchar"),
    "empresa_c": (name("(endereco::json ->> 'cidade')"), uf("(endereco::json ->> 'uf')")),
    "empresa_d": (name(address_city("Endereco")), uf(address_uf("Endereco"))),
    "empresa_e": (name("(address::json ->> 'city')"), uf("(address::json ->> 'state')")),
}
TYPES = {
    "empresa_a": f"coalesce(tipo_pessoa, {person('d')})",
    "empresa_b": "'PF'",
    "empresa_c": "'PJ'",
    "empresa_d": person("d"),
    "empresa_e": "case when coalesce(type, '') = 'business' then 'PJ' else 'PF' end",
}


def silver(key: tuple[str, str]) -> str:
    source, registry = key
    label = "cliente" if registry == "clientes" else "fornecedor"
    if source == "empresa_d":
        tag = "empresa_d_cli" if registry == "clientes" else "empresa_d_forn"
        unique, origin = f"md5('{tag}|' || d || '|' || coalesce(\"Nome\", ''))", "d"
    else:
        text, origin = IDS[source]
        unique = f"md5({text} || '|' || {origin})"
    city, state = PLACES[source]
    ok = "false" if source == "empresa_b" else valid("d")
    return f"""select {unique} as id_unicad, '{source}' as fonte, {origin} as id_origem,
  '{label}' as tipo_cadastro, {TYPES[source]} as tipo_pessoa, {name(NAMES[source])} as nome_razao_social,
  d as cpf_cnpj, {kind("d")} as cpf_cnpj_kind, {ok} as cpf_cnpj_valido, {email(MAILS[source])} as email,
  {phone(PHONES[source])} as telefone_principal, {city} as cidade, {state} as uf,
  {packed(EXTRAS[source])} as atributos_extras, _source, _ingested_at, _batch_id
from (select *, {doc(DOCS[source])} as d from ({newest(bronze(key), KEYS[source], bronze_columns(key))}) n) s"""


def registry(parts: list[tuple[str, str]]) -> str:
    return " union all ".join(f"({silver(key)})" for key in parts)


def with_(body: str, *names: str) -> str:
    """Put the model CTEs a query needs in front of it."""
    models = {}
    for suffix, parts in (("c", CUSTOMERS), ("f", SUPPLIERS)):
        models[f"silver_{suffix}"] = registry(parts)
        models[f"owner_{suffix}"] = (
            f"select email, min('doc:' || cpf_cnpj) as owner from silver_{suffix} "
            "where cpf_cnpj_valido and email is not null group by email"
        )
        models[f"cluster_{suffix}"] = f"""select s.*,
  coalesce(case when cpf_cnpj_valido then 'doc:' || cpf_cnpj end, owner, 'lone:' || id_unicad) as cluster_key,
  case when coalesce(cpf_cnpj_valido, false) then 'doc_match' when owner is not null then 'email_to_doc_match'
       else 'singleton' end as match_method
from silver_{suffix} s left join owner_{suffix} o on s.email = o.email"""
        models[f"ids_{suffix}"] = f"""select cluster_key, string_agg(fonte || '=' || coalesce(id, ''), '|' order by fonte) as ids
from (select cluster_key, fonte, min(id_origem) as id from cluster_{suffix} group by cluster_key, fonte) p group by cluster_key"""
        models[f"kind_{suffix}"] = f"""select cluster_key, tipo_pessoa from (
  select cluster_key, tipo_pessoa, row_number() over (partition by cluster_key order by count(*) desc, tipo_pessoa) as place
  from cluster_{suffix} where tipo_pessoa is not null group by cluster_key, tipo_pessoa) t where place = 1"""
        models[f"grouped_{suffix}"] = f"""select cluster_key,
  arg_max(nome_razao_social, (length(nome_razao_social), nome_razao_social)) as nome_razao_social,
  max(cpf_cnpj) filter (cpf_cnpj_valido) as cpf_cnpj, max(cpf_cnpj_kind) filter (cpf_cnpj_valido) as cpf_cnpj_kind,
  list_sort(list(distinct email) filter (email is not null)) as emails,
  list_sort(list(distinct telefone_principal) filter (telefone_principal is not null)) as telefones,
  list_sort(list(distinct fonte || ':' || coalesce(cidade, '') || ':' || coalesce(uf, ''))
    filter (cidade is not null or uf is not null)) as enderecos,
  list_sort(list(distinct fonte)) as fontes, count(distinct fonte) as total_fontes,
  list_sort(list(distinct match_method)) as metodos_match,
  list_sort(list(fonte || ':' || atributos_extras)) as atributos,
  min(_ingested_at) as primeira_aparicao, max(_ingested_at) as ultima_atualizacao, count(*) as registros
from cluster_{suffix} group by cluster_key"""
        models[f"golden_{suffix}"] = f"""select md5(g.cluster_key) as id_golden, g.*, k.tipo_pessoa, i.ids as ids_origem,
  (cast(nome_razao_social is not null as int) + cast(cpf_cnpj is not null as int) + cast(emails is not null as int)
   + cast(telefones is not null as int) + cast(enderecos is not null as int) + cast(k.tipo_pessoa is not null as int)
   + cast(total_fontes > 1 as int) + 1) / 8.0::double as score_completude
from grouped_{suffix} g left join kind_{suffix} k on g.cluster_key is not distinct from k.cluster_key
left join ids_{suffix} i on g.cluster_key is not distinct from i.cluster_key"""
    for s, label in (("c", "clientes"), ("f", "fornecedores")):
        models[f"by_source_{s}"] = f"""select '{label}' as tipo_cadastro, fonte, count(*) as registros_prata,
  count(*) filter (cpf_cnpj_valido) as com_doc_valido, count(email) as com_email,
  count(telefone_principal) as com_telefone, count(cidade) as com_cidade, count(uf) as com_uf
from silver_{s} group by fonte"""
        models[f"by_registry_{s}"] = f"""select '{label}' as tipo_cadastro, count(*) as ouro, avg(score_completude) as score,
  avg(total_fontes) as fontes, count(*) filter (total_fontes > 1) as multi from golden_{s}"""
    models["metrics"] = """select tipo_cadastro, fonte, registros_prata, com_doc_valido, com_email, com_telefone,
  com_cidade, com_uf, round(com_doc_valido / registros_prata::double, 3) as pct_doc_valido,
  round(com_email / registros_prata::double, 3) as pct_email,
  round(com_telefone / registros_prata::double, 3) as pct_telefone,
  round(com_cidade / registros_prata::double, 3) as pct_cidade,
  null::double as score_completude_medio, null::double as fontes_medias_por_registro,
  null::bigint as registros_multi_fonte, null::bigint as registros_ouro, null::double as taxa_deduplicacao
from (select * from by_source_c union all select * from by_source_f) b
union all
select o.tipo_cadastro, '_TOTAL', p.total, null, null, null, null, null, null, null, null, null,
  round(score, 3), round(fontes, 3), multi, ouro, round(1 - ouro / p.total::double, 3)
from (select * from by_registry_c union all select * from by_registry_f) o
join (select tipo_cadastro, cast(sum(registros_prata) as bigint) as total
      from (select * from by_source_c union all select * from by_source_f) b group by tipo_cadastro) p
  on o.tipo_cadastro = p.tipo_cadastro"""
    needed: set[str] = set(names)
    grown = True
    while grown:
        more = {m for n in needed for m in models if m != n and m in _words(models[n])}
        grown = not more <= needed
        needed |= more
    chain = ",\n".join(f"{n} as ({models[n]})" for n in models if n in needed)
    return f"with {chain}\n{body}"


def _words(text: str) -> set[str]:
    word, words = "", set()
    for c in text + " ":
        if c.isalnum() or c == "_":
            word += c
        elif word:
            words.add(word)
            word = ""
    return words


SUMMARY_FLAT = """id_golden, nome_razao_social, cpf_cnpj, cpf_cnpj_kind, tipo_pessoa,
  coalesce(array_to_string(emails, '|'), '') as emails, coalesce(array_to_string(telefones, '|'), '') as telefones,
  coalesce(array_to_string(enderecos, '|'), '') as enderecos, array_to_string(fontes, '|') as fontes,
  total_fontes, score_completude"""

GOLDEN_FLAT = """id_golden, cluster_key, tipo_pessoa, nome_razao_social, cpf_cnpj, cpf_cnpj_kind,
  array_to_string(emails, '|') as emails, array_to_string(telefones, '|') as telefones,
  array_to_string(enderecos, '|') as enderecos, array_to_string(fontes, '|') as fontes, total_fontes,
  array_to_string(metodos_match, '|') as metodos_match, ids_origem,
  array_to_string(atributos, '|') as atributos_por_fonte, score_completude, primeira_aparicao,
  ultima_atualizacao, 1 as versao"""


def search(where: str, page: int = 1, per_page: int = 25) -> str:
    offset = (page - 1) * per_page
    return with_(
        f"""select {SUMMARY_FLAT}, total, {offset + per_page} < total as has_next from (
  select *, count(*) over () as total from golden_c where {where}) m
order by score_completude desc, nome_razao_social nulls last, id_golden nulls last limit {per_page} offset {offset}""",
        "golden_c",
    )


def detail_columns() -> str:
    return f"""{SUMMARY_FLAT}, array_to_string(metodos_match, '|') as metodos_match, ids_origem,
  array_to_string(atributos, '|') as atributos_por_fonte,
  strftime(primeira_aparicao::timestamptz at time zone 'UTC', '%Y-%m-%d %H:%M:%S.%f') as primeira_aparicao,
  strftime(ultima_atualizacao::timestamptz at time zone 'UTC', '%Y-%m-%d %H:%M:%S.%f') as ultima_atualizacao, 1 as versao"""


def check_digits(d: str) -> str:
    def digit(number: str, weights: list[int]) -> str:
        total = f"list_sum(list_transform({weights}, lambda w, i: w * cast(({number})[i] as int)))"
        return f"cast(case when {total} % 11 in (0, 1) then 0 else 11 - {total} % 11 end as int)::varchar"

    def both(size: int, first: list[int], second: list[int]) -> str:
        one = digit(f"{d}[1:{size}]", first)
        return f"{one} || {digit(f'{d}[1:{size}] || {one}', second)}"

    tail = list(range(9, 1, -1))
    cpf = both(9, list(range(10, 1, -1)), list(range(11, 1, -1)))
    cnpj = both(12, [5, 4, 3, 2, *tail], [6, 5, 4, 3, 2, *tail])
    return f"case when length({d}) = 11 then {cpf} when length({d}) = 14 then {cnpj} end"


SHORT = "id_golden, cluster_key, tipo_pessoa, nome_razao_social, cpf_cnpj, cpf_cnpj_kind"
SILVER_OUT = (
    "id_unicad, fonte, id_origem, tipo_cadastro, tipo_pessoa, nome_razao_social, cpf_cnpj, cpf_cnpj_kind, "
    "cpf_cnpj_valido, email, telefone_principal, cidade, uf, atributos_extras, _source, _ingested_at, _batch_id"
)
CUSTOMER_KEY = "doc:00012587033"
COMPANY_KEY = "doc:87932904000104"
LARGE_FROM = 8


def rows(key: tuple[str, str], columns: str) -> str:
    return f"select {columns} from ({bronze(key)}) b"


def std(key: tuple[str, str]) -> str:
    return f"select {SILVER_OUT} from ({silver(key)}) s"


def bronze_union() -> str:
    parts = []
    for key in BRONZE:
        identity = " replace (cast(id as varchar) as id)" if key[0] == "empresa_a" else ""
        parts.append(f"(select *{identity} from ({bronze(key)}) b)")
    return " union all by name ".join(parts)


def contract_row(table: str, column: str, rule: str, failing: str) -> str:
    return (
        f"select '{table}' as tabela, '{column}' as coluna, '{rule}' as regra, n as falhas, "
        f"case when n = 0 then 'pass' else 'fail' end as status from ({failing}) c"
    )


def stored(model: str) -> str:
    """SQL source of a model named in a check."""
    parts = model.split("_")
    if model.startswith("stg_"):
        return f"({silver((f'empresa_{parts[2]}', parts[3]))})"
    if model.startswith("empresa_"):
        return f"({bronze((f'empresa_{parts[1]}', parts[2]))})"
    suffix = "c" if "clientes" in model else "f"
    if model.startswith("golden_"):
        return f"golden_{suffix}"
    return f"cluster_{suffix}" if model.endswith("cluster") else f"silver_{suffix}"


def report(checks: list[tuple[str, str, str]], rule: str) -> str:
    """Checks as (table, column, failing condition); for `unique` the condition is not used."""
    parts = []
    for model, column, condition in checks:
        if rule == "unique":
            failing = (
                f"select count(*) as n from (select {column} from {stored(model)} x where {column} is not null "
                f"group by {column} having count(*) > 1) d"
            )
        else:
            failing = f"select count(*) as n from {stored(model)} x where {condition}"
        parts.append(contract_row(model, column, rule, failing))
    return with_(" union all ".join(parts), "golden_c", "golden_f")


NOT_NULL = [
    ("empresa_a_clientes", "_source"),
    ("empresa_a_clientes", "_batch_id"),
    *[
        (f"stg_empresa_{s}_{r}", "id_unicad")
        for s, r in (
            ("a", "clientes"),
            ("a", "fornecedores"),
            ("b", "clientes"),
            ("c", "fornecedores"),
            ("d", "clientes"),
            ("d", "fornecedores"),
            ("e", "clientes"),
        )
    ],
    ("stg_empresa_a_clientes", "fonte"),
    ("int_clientes_padronizados", "id_unicad"),
    ("int_clientes_padronizados", "fonte"),
    ("int_fornecedores_padronizados", "id_unicad"),
    ("int_fornecedores_padronizados", "fonte"),
    ("int_clientes_cluster", "id_unicad"),
    ("int_clientes_cluster", "cluster_key"),
    ("int_clientes_cluster", "match_method"),
    ("int_fornecedores_cluster", "id_unicad"),
    ("int_fornecedores_cluster", "cluster_key"),
    ("golden_clientes", "id_golden"),
    ("golden_clientes", "cluster_key"),
    ("golden_clientes", "score_completude"),
    ("golden_fornecedores", "id_golden"),
    ("golden_fornecedores", "cluster_key"),
]
UNIQUE = [
    *[
        (f"stg_empresa_{s}_{r}", "id_unicad")
        for s, r in (
            ("a", "clientes"),
            ("a", "fornecedores"),
            ("b", "clientes"),
            ("c", "fornecedores"),
            ("e", "clientes"),
        )
    ],
    ("golden_clientes", "id_golden"),
    ("golden_clientes", "cluster_key"),
    ("golden_fornecedores", "id_golden"),
    ("golden_fornecedores", "cluster_key"),
]
ACCEPTED = [
    ("stg_empresa_a_clientes", "fonte", "'empresa_a'"),
    ("stg_empresa_a_clientes", "tipo_cadastro", "'cliente'"),
    ("stg_empresa_a_fornecedores", "tipo_cadastro", "'fornecedor'"),
    ("stg_empresa_b_clientes", "tipo_pessoa", "'PF'"),
    ("stg_empresa_c_fornecedores", "tipo_pessoa", "'PJ'"),
    ("int_clientes_padronizados", "fonte", "'empresa_a', 'empresa_b', 'empresa_d', 'empresa_e'"),
    ("int_clientes_padronizados", "tipo_cadastro", "'cliente'"),
    ("int_clientes_padronizados", "tipo_pessoa", "'PF', 'PJ'"),
    ("int_fornecedores_padronizados", "fonte", "'empresa_a', 'empresa_c', 'empresa_d'"),
    ("int_fornecedores_padronizados", "tipo_cadastro", "'fornecedor'"),
    ("int_clientes_cluster", "match_method", "'doc_match', 'email_to_doc_match', 'singleton'"),
]


def freshness() -> str:
    parts = [
        f"select '{source}_{kind_}' as unique_id, max(_ingested_at::timestamptz) as newest from ({bronze((source, kind_))}) b"
        for source, kind_ in BRONZE
    ]
    age = "(epoch_us(timestamptz '2024-01-03 00:00:00+00') - epoch_us(newest)) / 3600000000.0::double"
    return f"""select unique_id, round({age}, 6) as age_hours,
  case when {age} > 36 then 'error' when {age} > 12 then 'warn' else 'pass' end as status
from ({" union all ".join(parts)}) s"""


HISTORY = """select cast(user_id as varchar) as unique_id, ts as generated_at,
  case when event_type = 'error' then 'runtime_error' when value > 90 then 'warn' else 'pass' end as status from events"""
LATEST_CHECK = f"""select unique_id, arg_min(status, (-epoch_us(generated_at), status)) as status
from ({HISTORY}) h group by unique_id"""


def anomaly(runs: str, by: str) -> str:
    over = f"over (partition by {by} order by dia rows between 14 preceding and 1 preceding)"
    return f"""select {by}, dia, registros, n as execucoes_base, coalesce(n >= 7 and s > 0 and abs(registros - m) > 3 * s, false) as anomalia,
  round(m, 6) as media, round(s, 6) as desvio, case when n >= 7 and s > 0 then round((registros - m) / s, 6) end as z
from (select *, count(*) {over} as n, avg(registros::double) {over} as m, stddev_samp(registros::double) {over} as s
      from ({runs}) r) w"""


def golden_list(column: str, value: str, where: str) -> str:
    fields = {"valor": "null::varchar", "cidade": "null::varchar", "uf": "null::varchar", "fonte": "null::varchar"}
    for part in value.split(", "):
        source, _, target = part.partition(" as ")
        fields[target or source] = source
    picked = ", ".join(f"{source} as {target}" for target, source in fields.items())
    return (
        f"select md5(c.cluster_key) as id_golden, c.cluster_key, '{column}' as lista, {picked}, count(*) as registros "
        f"from cluster_c c join big b on c.cluster_key is not distinct from b.cluster_key where {where} group by all"
    )


BIG = f"(select cluster_key from cluster_c group by cluster_key having count(*) > {LARGE_FROM})"


def source_rows(source: str, key: str) -> str:
    columns = bronze_columns((source, "clientes"))
    inner = f"select *, {key} as _key from ({bronze((source, 'clientes'))}) b"
    pairs = ", ".join(f"'{c}', \"{c}\"" for c in sorted(columns))
    latest = newest(f"select * from ({inner}) k where _key is not null", ["_key"], columns)
    return f"select '{source}' as fonte, _key as id, cast(json_object({pairs}) as varchar) as registro from ({latest}) l"


def spelt() -> str:
    p = "(c_custkey * 37) % 100"
    full = "'José ' || c_name"
    d = "lpad(cast(c_custkey * 48271 as varchar), 11, '0')"
    m = f"regexp_replace({d}, '^(...)(...)(...)(..)$', '\\1.\\2.\\3-\\4')"
    number = "('9' || lpad(cast(c_custkey as varchar), 8, '0'))"
    blocks = f"{number}[1:3] || ' ' || {number}[4:6] || ' ' || {number}[7:9]"
    return f"""select c_custkey, case when {p} < 25 then {full} when {p} < 50 then lower({full})
    when {p} < 75 then replace({full}, ' ', '  ') else ' ' || strip_accents({full}) || '   ' end as "Nome",
  case when {p} < 33 then {d} else {m} end as "Documento",
  case c_custkey % 4 when 0 then '11.' || {number} when 1 then 'tel +5511' || {number}
    when 2 then '11/' || {blocks} else {blocks} end as "Fone",
  case when {p} < 12 then '' else 'c' || cast(c_custkey as varchar) || '@x.com' end as "Email"
from (select * from customer union all select * from customer where (c_custkey * 37) % 100 < 5) c"""


def two_source_lake() -> str:
    """Row counts when only company A's customers and company C's suppliers were loaded, in one batch each."""
    parts = []
    for key in (CUSTOMERS[0], SUPPLIERS[1]):
        source, registry_ = key
        stamped = (
            "select * replace ('2024-01-03T00:00:00+00:00' as _ingested_at, 'lote-1' as _batch_id) "
            f"from ({bronze(key)}) z"
        )
        layer = silver(key).replace(bronze(key), stamped)
        owners = "select email, min(cpf_cnpj) as d from s where cpf_cnpj_valido and email is not null group by email"
        own = (
            "case when cpf_cnpj_valido and cpf_cnpj is not null then 'doc:' || cpf_cnpj "
            "when o.d is not null then 'doc:' || o.d else 'lone:' || id_unicad end"
        )
        counts = f"""(with s as ({layer}), o as ({owners})
  select count(*) as n, count(distinct {own}) as g from s left join o on s.email = o.email)"""
        for model, count in (
            (f"stg_{source}_{registry_}", "n"),
            (f"int_{registry_}_padronizados", "n"),
            (f"int_{registry_}_cluster", "n"),
            (f"golden_{registry_}", "g"),
        ):
            parts.append(f"select '{model}' as modelo, {count}::bigint as registros from {counts} c")
    for source, registry_ in BRONZE:
        if (source, registry_) not in (CUSTOMERS[0], SUPPLIERS[1]):
            parts.append(f"select 'stg_{source}_{registry_}' as modelo, 0::bigint as registros")
    return " union all ".join(parts)


A, B, C, D, E = CUSTOMERS[0], CUSTOMERS[1], SUPPLIERS[1], CUSTOMERS[2], CUSTOMERS[3]
DF, AF = SUPPLIERS[2], SUPPLIERS[0]

ORACLE: dict[str, str] = {
    "norm_clean_doc": rows(D, f'"Documento", {doc("Documento")} as doc'),
    "norm_doc_kind": rows(A, f"cpf_cnpj, {kind(doc('cpf_cnpj'))} as kind"),
    "norm_doc_valid": f"select cpf_cnpj, {valid('d')} as valido from ({rows(A, f'cpf_cnpj, {doc("cpf_cnpj")} as d')}) x",
    "norm_tipo_pessoa": rows(D, f'"Documento", {person(doc("Documento"))} as tipo'),
    "norm_e164": rows(DF, f'b."Fone" as "Fone", {phone("b.Fone")} as e164'),
    "norm_email": rows(A, f"email, {email('b.email')} as limpo"),
    "norm_nome": rows(B, f"full_name, {name('full_name')} as nome"),
    "norm_uf": rows(A, f"endereco_uf, {uf('endereco_uf')} as uf"),
    "addr_city_uf": rows(DF, f'"Endereco", {address_city("Endereco")} as cidade, {address_uf("Endereco")} as uf'),
    "id_unicad": rows(AF, "id, md5(concat('empresa_a|', id)) as id_unicad"),
    "id_golden": rows(C, f"cnpj, md5('doc:' || {doc('cnpj')}) as id_golden"),
    "json_extract": "select event_id, props::json ->> 'k' as k, props::json ->> 'missing' as missing from events",
    "json_pack": rows(
        C,
        "_id, endereco::json ->> 'cidade' as cidade, endereco::json ->> 'numero' as numero, "
        f"{packed(same('_id', 'avaliacao_media', 'observacoes', 'endereco'))} as texto",
    ),
    "doc_mask": f"""select "Documento", case length(d) when 11 then regexp_replace(d, '^(...)(...)(...)(..)$', '\\1.\\2.\\3-\\4')
  when 14 then regexp_replace(d, '^(..)(...)(...)(....)(..)$', '\\1.\\2.\\3/\\4-\\5') else d end as mascara
from ({rows(D, f'"Documento", {doc("Documento")} as d')}) x""",
    "doc_check_digits": f"""select "Documento", {check_digits("d")} as digitos,
  case when d is not null then coalesce(right(d, 2) = {check_digits("d")}, false) end as confere
from ({rows(D, f'"Documento", {doc("Documento")} as d')}) x""",
    "deaccent": rows(DF, '"Endereco", strip_accents("Endereco") as texto'),
    "strip_punct": rows(A, "cpf_cnpj, regexp_replace(cpf_cnpj, '[^0-9]', '', 'g') as digitos"),
    "dirty_spellings": spelt(),
    "latest_per_key": "select user_id, event_id, event_type, value, props from ("
    + newest("select * from events", ["user_id"], ["event_id", "event_type", "props", "ts", "user_id", "value"], "ts", ())
    + ") n",
    "latest_per_composite_key": newest(bronze(D), ["Documento", "Nome"], bronze_columns(D)),
    **{f"std_{source[-1]}_{registry_}": std((source, registry_)) for source, registry_ in BRONZE},
    "union_clientes": with_(f"select {SILVER_OUT} from silver_c", "silver_c"),
    "union_fornecedores": with_(f"select {SILVER_OUT} from silver_f", "silver_f"),
    "iso_dates": """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S')
  || case when microsecond(ts) % 1000000 = 0 then '' else strftime(ts, '.%f') end as ts from events""",
    "bronze_batch": rows(
        A,
        "* exclude (_source, _ingested_at, _batch_id) replace (null::varchar as endereco_rua), 'empresa_a' as _source, "
        "'2024-01-03T00:00:00+00:00' as _ingested_at, 'lote-1' as _batch_id",
    ),
    "landed_csv": rows(D, "* exclude (_source, _ingested_at, _batch_id)"),
    "landed_documents": """select cast(event_id as varchar) as _id, event_type as tipo,
  case when event_type <> 'click' then value end as valor,
  case when user_id % 2 = 0 then replace(props, ' ', '') end as props from events""",
    "landed_pages": "select * from customer",
    "landed_quarantine": rows(
        D,
        "count(*) filter (not \"Fone\" like '%7') as gravados, 'empresa_d' as _source, 'lote-1' as _batch_id, "
        "'unreadable' as motivo, count(*) filter (\"Fone\" like '%7') as quarentena, true as confere",
    ),
    "bronze_all": bronze_union(),
    "email_to_cluster": with_("select email, owner as cluster_via_email from owner_c", "owner_c"),
    "cluster_clientes": with_(f"select {SILVER_OUT}, cluster_key, match_method from cluster_c", "cluster_c"),
    "cluster_fornecedores": with_(f"select {SILVER_OUT}, cluster_key, match_method from cluster_f", "cluster_f"),
    "golden_clientes": with_(f"select {GOLDEN_FLAT} from golden_c", "golden_c"),
    "golden_fornecedores": with_(f"select {GOLDEN_FLAT} from golden_f", "golden_f"),
    "golden_score": with_("select id_golden, total_fontes, score_completude from golden_c", "golden_c"),
    "golden_ids_origem": with_(
        "select cluster_key, fonte, min(id_origem) as id_origem from cluster_f group by cluster_key, fonte",
        "cluster_f",
    ),
    "golden_large_clusters": with_(
        f"""select {SHORT}, array_to_string(fontes, '|') as fontes, array_to_string(metodos_match, '|') as metodos_match,
  ids_origem, score_completude, primeira_aparicao, ultima_atualizacao, registros > {LARGE_FROM} as em_listas from golden_c""",
        "golden_c",
    ),
    "golden_large_lists": with_(
        f"select * from (with big as {BIG} "
        + " union all ".join(
            [
                golden_list("emails", "email as valor", "email is not null"),
                golden_list("telefones", "telefone_principal as valor", "telefone_principal is not null"),
                golden_list("enderecos", "cidade, uf, fonte", "cidade is not null or uf is not null"),
                golden_list("atributos_por_fonte", "atributos_extras as valor, fonte", "true"),
            ]
        )
        + ") l",
        "cluster_c",
    ),
    "golden_hot_cluster": """
with r as (
  select case when l_returnflag = 'R' then '00000000191' else lpad(l_suppkey::varchar, 11, '5') end as doc,
    'empresa_' || lower(l_linestatus) as fonte, l_orderkey::varchar as id, 'p' || l_partkey || '@x.com' as email,
    l_linestatus as uf, l_quantity::int as q, 'Item ' || l_partkey as nome, l_linenumber as n
  from lineitem
), ids as (select doc, fonte, min(id) as id from r group by 1, 2
), mails as (select doc, count(*) as n, md5(string_agg(email, '|' order by email)) as m
  from (select distinct doc, email from r) group by 1
)
select 'doc:' || r.doc as cluster_key, any_value(mails.n)::bigint as emails, any_value(m) as emails_md5,
  (select string_agg(fonte || ':' || upper(fonte[9:]), '|' order by upper(fonte[9:])) from ids i where i.doc = r.doc) as enderecos,
  count(*)::bigint as atributos, sum(q)::bigint as soma,
  (select string_agg(fonte || '=' || id, '|' order by fonte) from ids i where i.doc = r.doc) as ids_origem,
  max_by(nome, length(nome)::varchar || nome) as nome_razao_social,
  (6 + (count(distinct fonte) > 1)::int + (count(*) filter (r.n > 1) > 0)::int - 1)::double / 8.0 as score_completude
from r join mails on r.doc = mails.doc group by r.doc
""",
    "golden_list_rows": with_(
        "select distinct md5(cluster_key) as id_golden, cidade, uf, fonte from cluster_c "
        "where cidade is not null or uf is not null",
        "cluster_c",
    ),
    "id_conflicts": with_(
        """select cluster_key, fonte, count(distinct coalesce(id_origem, '-')) as ids, min(id_origem) as id_mantido
from cluster_c group by cluster_key, fonte having count(distinct coalesce(id_origem, '-')) > 1""",
        "cluster_c",
    ),
    "metricas_qualidade": with_("select * from metrics", "metrics"),
    "lake_of_two_sources": two_source_lake(),
    "overlap_histogram": with_(
        "select total_fontes, count(*) as entidades from golden_c group by total_fontes", "golden_c"
    ),
    "search_name": search("contains(lower(nome_razao_social), 'customer 00000')"),
    "search_doc": search("cpf_cnpj = '00012587033'"),
    "search_email": search("len(list_filter(emails, lambda x: contains(x, 'cliente12'))) > 0"),
    "search_phone": search("len(list_filter(telefones, lambda x: contains(x, '55219'))) > 0"),
    "search_city": search(
        "len(list_filter(enderecos, lambda x: contains(lower(split_part(x, ':', 2)), 'paraná'))) > 0"
    ),
    "search_uf": search(
        "len(list_filter(enderecos, lambda x: split_part(x, ':', 3) = 'SP')) > 0 and nome_razao_social ilike '%cia_2%'"
    ),
    "search_page2": search(
        "len(list_filter(enderecos, lambda x: contains(lower(split_part(x, ':', 2)), 'são'))) > 0", 2, 40
    ),
    "search_no_digits": search("true", 1, 100),
    "page_deep": """select line_id, price, flag from (
  select l_orderkey * 8 + l_linenumber as line_id, max(l_extendedprice) as price, max(l_returnflag) as flag
  from lineitem group by line_id) l order by flag, price desc, line_id limit 100 offset 30000""",
    "detail": with_(f"select {detail_columns()} from golden_c where cluster_key = '{CUSTOMER_KEY}'", "golden_c"),
    "resolve_entity": with_(
        f"""select {detail_columns()} from (select *, 0 as prio from golden_c union all select *, 1 from golden_f) g
where cluster_key = '{COMPANY_KEY}' order by prio limit 1""",
        "golden_c",
        "golden_f",
    ),
    "resolve_entity_all": with_(
        f"""select registro, id_golden, cpf_cnpj, nome_razao_social, total_fontes
from (select *, 'clientes' as registro from golden_c union all select *, 'fornecedores' from golden_f) g
where cluster_key = '{COMPANY_KEY}'""",
        "golden_c",
        "golden_f",
    ),
    "health": with_(
        "select 'ok' as status, (select count(*) from golden_c) as clientes, (select count(*) from golden_f) as fornecedores",
        "golden_c",
        "golden_f",
    ),
    "metrics_listing": with_("select * from metrics", "metrics"),
    "sql_normalizers": f"""select "Nome", {name('"Nome"')} as nome, d as doc, {kind("d")} as kind, {valid("d")} as valido,
  {person("d")} as tipo, {phone('"Fone"')} as fone, {email('"Email"')} as mail,
  {uf('right(trim("Endereco"), 2)')} as uf, md5('empresa_d|' || d) as id
from (select *, {doc('"Documento"')} as d from ({bronze(D)}) b) x""",
    "sql_views": with_(
        """select c.uf, count(distinct g.id_golden) as clientes, max(g.score_completude) as melhor
from golden_c g join cluster_c c on g.cluster_key is not distinct from c.cluster_key
where g.total_fontes > 1 and (c.cidade is not null or c.uf is not null) group by c.uf""",
        "golden_c",
    ),
    "sql_unique": with_(
        "select count(*) as clientes_unicos, count(*) filter (total_fontes > 1) as em_mais_de_uma_subsidiaria from golden_c",
        "golden_c",
    ),
    "sql_shared_suppliers": with_(
        """select nome_razao_social, cpf_cnpj, total_fontes, array_to_string(fontes, '|') as fontes from golden_f
where total_fontes > 1 order by total_fontes desc, nome_razao_social nulls last, id_golden limit 5""",
        "golden_f",
    ),
    "sql_by_uf": with_(
        """select uf, count(distinct md5(cluster_key)) as clientes from cluster_c where cidade is not null or uf is not null
group by uf order by clientes desc, uf nulls last limit 5""",
        "cluster_c",
    ),
    "sql_quality": with_(
        """select fonte, registros_prata, pct_doc_valido, pct_email, pct_cidade from metrics
where tipo_cadastro = 'clientes' and fonte <> '_TOTAL'""",
        "metrics",
    ),
    "lineage": with_(
        """select g.id_golden, g.nome_razao_social as golden, c.fonte, c.id_origem, c.nome_razao_social as nome_na_fonte,
  c.email, c.telefone_principal from golden_c g join cluster_c c on g.cluster_key = c.cluster_key""",
        "golden_c",
    ),
    "lineage_one": with_(
        f"""select g.id_golden, g.nome_razao_social as golden, c.fonte, c.id_origem, c.nome_razao_social as nome_na_fonte,
  c.email, c.telefone_principal from golden_c g join cluster_c c on g.cluster_key = c.cluster_key
where g.cluster_key = '{CUSTOMER_KEY}'""",
        "golden_c",
    ),
    "source_lookup": with_(
        f"""select md5(i.cluster_key) as id_golden, i.fonte, i.id as id_origem, b.registro
from (select cluster_key, fonte, min(id_origem) as id from cluster_c group by cluster_key, fonte) i join (
{source_rows("empresa_a", "cast(id as varchar)")} union all {source_rows("empresa_b", "cast(client_id as varchar)")} union all
{source_rows("empresa_d", doc("Documento"))} union all {source_rows("empresa_e", "id")}) b
on i.fonte = b.fonte and i.id = b.id""",
        "cluster_c",
    ),
    "page_envelope": """select cast((place - 1) // 25 + 1 as bigint) as page, 25::bigint as per_page, total, page * 25 < total as has_next,
  count(*) as registros, '[' || string_agg(cast(json_object('c_custkey', c_custkey, 'c_name', c_name, 'c_nationkey', c_nationkey,
    'c_acctbal', c_acctbal, 'c_mktsegment', c_mktsegment) as varchar), ',' order by place) || ']' as data
from (select *, row_number() over (order by c_custkey) as place, count(*) over () as total from customer) c group by page, total""",
    "dq_not_null": report([(t, c, f"{c} is null") for t, c in NOT_NULL], "not_null"),
    "dq_unique": report([(t, c, "") for t, c in UNIQUE], "unique"),
    "dq_accepted": report([(t, c, f"{c} not in ({v})") for t, c, v in ACCEPTED], "accepted_values"),
    "dq_accepted_where": report(
        [("golden_clientes", "tipo_pessoa", "tipo_pessoa is not null and tipo_pessoa not in ('PF', 'PJ')")],
        "accepted_values",
    ),
    "freshness": freshness(),
    "freshness_counts": f"select status, count(*) as fontes from ({LATEST_CHECK}) l group by status",
    "freshness_rollup": f"""select passou, avisos, erros, case when erros > 0 then 'error' when avisos > 0 or passou = 0 then 'warn' else 'ok' end as status
from (select count(*) filter (status = 'pass') as passou, count(*) filter (status = 'warn') as avisos,
      count(*) filter (status in ('error', 'runtime_error')) as erros from ({LATEST_CHECK}) l) c""",
    "volume_anomaly": anomaly(
        "select 'orders' as tabela, cast(o_orderdate::date as varchar) as dia, count(*) as registros from orders group by all",
        "tabela",
    ),
    "dimension_anomaly": anomaly(
        "select event_type, cast(ts::date as varchar) as dia, count(*) as registros from events group by all",
        "event_type",
    ),
}

# The same tables by other ways: built batch by batch, and followed as a stream.
ORACLE["incremental_gold"] = ORACLE["golden_clientes"]
ORACLE["change_feed"] = ORACLE["latest_per_key"]
ORACLE["search_name_index"] = ORACLE["search_name"]
ORACLE["search_all_index"] = search(
    """lower(nome_razao_social) like '%cust%r 0_0%' and len(list_filter(emails, lambda x: contains(x, 'cliente'))) > 0
    and len(list_filter(telefones, lambda x: contains(x, '55'))) > 0""",
    per_page=100,
)
ORACLE["schema_drift"] = """
with c as (select column_name as coluna, case data_type when 'VARCHAR' then 'string' when 'INTEGER' then 'int' else lower(data_type) end as tipo
  from information_schema.columns where table_name = 'customer')
select 'customer' as tabela, run_ts, coluna, mudanca, antes, depois, (select count(*) from customer) as registros from (
  select '2024-01-02' as run_ts, coluna, 'added' as mudanca, null as antes, tipo as depois from c where coluna = 'c_mktsegment'
  union all select '2024-01-03', coluna, 'removed', tipo, null from c where coluna = 'c_nationkey'
  union all select '2024-01-03', coluna, 'type_changed', tipo, 'string' from c where coluna = 'c_acctbal')
"""
