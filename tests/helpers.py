"""Small silver tables and comparison helpers."""

from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from goldenrec.schemas import SILVER

# A failing task reaches Python as one or the other, depending on the stage it fails in.
FAILED_QUERY = (PySparkException, Py4JJavaError)

RUN_TS = datetime(2024, 2, 1, tzinfo=UTC)

DEFAULTS = {
    "id_unicad": None,
    "fonte": "empresa_a",
    "id_origem": None,
    "tipo_cadastro": "cliente",
    "tipo_pessoa": "PF",
    "nome_razao_social": "Ana",
    "cpf_cnpj": None,
    "cpf_cnpj_kind": None,
    "cpf_cnpj_valido": None,
    "email": None,
    "telefone_principal": None,
    "cidade": None,
    "uf": None,
    "atributos_extras": "{}",
    "_source": "x",
    "_ingested_at": "2024-01-01T00:00:00+00:00",
    "_batch_id": "b1",
    "_processed_at": RUN_TS,
}


def silver(spark, *rows):
    """Silver rows from the fields that matter; ids default to a running number."""
    full = []
    for number, row in enumerate(rows):
        base = {**DEFAULTS, "id_unicad": f"u{number}", "id_origem": f"o{number}", **row}
        if base["cpf_cnpj"] and "cpf_cnpj_valido" not in row:
            base["cpf_cnpj_valido"] = True
            base["cpf_cnpj_kind"] = "CPF" if len(base["cpf_cnpj"]) == 11 else "CNPJ"
        full.append(tuple(base[f.name] for f in SILVER))
    return spark.createDataFrame(full, SILVER)


def as_set(frame, *drop):
    names = sorted(set(frame.columns) - set(drop))
    return sorted(str([row[n] for n in names]) for row in frame.select(names).collect())
