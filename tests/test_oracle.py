"""Every registered query against its DuckDB counterpart."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_names_agree():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, connection, name):
    verdict, _, _ = compare(spark, connection, SF, name)
    # a query without SQL counterpart has its brute-force test beside its operator
    assert verdict.startswith("ok" if name in oracle_sql() else "rows only"), verdict


def test_entry(spark):
    row = entry(spark).first()
    assert row.clientes_unicos > row.em_mais_de_uma_subsidiaria > 0


def test_columns_that_differ_in_case_are_stored_and_read(spark, tmp_path):
    frame = queries()["sql_normalizers"](spark, SF)
    frame.write.parquet(f"{tmp_path}/out")
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert stored.columns == frame.columns and {"Nome", "nome"} <= set(stored.columns)
    assert stored.exceptAll(frame).isEmpty() and frame.exceptAll(stored).isEmpty()
    queries()["iso_dates"](spark, SF)
    assert spark.conf.get("spark.sql.caseSensitive") == "false"
