"""Source readers, bronze batches and file listings."""

import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from goldenrec import schemas
from goldenrec.sources import bronze as B
from goldenrec.sources import readers as R
from helpers import FAILED_QUERY

AT = datetime(2024, 3, 5, 6, 7, 8, 250000, tzinfo=UTC)


def test_csv_keeps_text_as_it_was(spark, tmp_path):
    path = tmp_path / "clientes.csv"
    path.write_text(
        "Nome,Documento,Fone,Email,Endereco,Obs\r\n"
        '  Ana ,007,,NA,"Rua ""X"", 12\nfundos - SP",null\r\n',
        encoding="utf-8",
    )
    rows = [tuple(r) for r in R.read_csv_text(spark, str(path)).collect()]
    assert rows == [("  Ana ", "007", "", "NA", 'Rua "X", 12\nfundos - SP', "null")]


def test_documents_of_any_shape(spark, tmp_path):
    docs = [
        {"_id": "a", "avaliacao_media": 4.5, "categorias": ["x", "é"], "endereco": {"cidade": None}},
        {"_id": "b", "observacoes": "oi", "novo": 3},
        {"_id": "c", "avaliacao_media": 4, "novo": None},
    ]
    path = tmp_path / "docs.ndjson"
    path.write_text("\n".join(json.dumps(d, ensure_ascii=False) for d in docs), encoding="utf-8")
    frame = B.extract_c(spark, str(path))["fornecedores"]
    rows = {r["_id"]: r for r in frame.collect()}
    assert frame.columns[-2:] == ["novo", "_corrupt"]
    assert json.loads(rows["a"].categorias) == ["x", "é"]
    assert json.loads(rows["a"].endereco) == {"cidade": None}
    assert (rows["a"].avaliacao_media, rows["c"].avaliacao_media) == (4.5, 4.0)
    assert (rows["b"].observacoes, rows["b"].novo, rows["b"].endereco, rows["c"].novo) == ("oi", "3", None, None)


def test_keys_with_quotes(spark, tmp_path):
    path = tmp_path / "odd.ndjson"
    path.write_text(json.dumps({"d'água": 1, "a b": True, "x.y": [1]}), encoding="utf-8")
    row = R.flatten_documents(R.read_documents(spark, str(path))).first()
    assert row.asDict() == {"a b": "true", "d'água": "1", "x.y": "[1]"}


def test_csv_without_line_breaks_splits(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text("Nome,Documento,Fone,Email,Endereco,Obs\n" + " a ,1,,,,\n" * 10)
    rows = R.read_csv_text(spark, str(path), line_breaks=False).collect()
    assert [tuple(r) for r in rows] == [(" a ", "1", "", "", "", "")] * 10


def test_too_many_keys_is_an_error(spark, monkeypatch, tmp_path):
    path = tmp_path / "wide.ndjson"
    path.write_text("\n".join(json.dumps({f"k{i}": 1}) for i in range(5)))
    monkeypatch.setattr(R, "MAX_DOCUMENT_KEYS", 4)
    with pytest.raises(ValueError, match="different keys"):
        R.flatten_documents(R.read_documents(spark, str(path)))


def _page(number, has_next, *ids):
    data = [{"id": i, "type": "business", "address": {"city": "Belém"}, "tags": []} for i in ids]
    return {"page": number, "per_page": 2, "total": 5, "has_next": has_next, "data": data}


def test_pages_until_the_last_one(spark, tmp_path):
    pages = [_page(1, True, "a", "b"), _page(2, True, "c", "d"), _page(3, False, "e"), _page(4, False, "stale")]
    for page in pages:
        (tmp_path / f"{page['page']}.json").write_text(json.dumps(page, indent=1))
    rows = B.extract_e(spark, str(tmp_path))["clientes"].collect()
    assert sorted(r.id for r in rows) == ["a", "b", "c", "d", "e"]
    assert json.loads(rows[0].address) == {"city": "Belém"} and rows[0].tags == "[]"


def test_iso_dates(spark):
    frame = spark.createDataFrame(
        [(1, date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 60))],
        "id long, d date, t timestamp_ntz, f timestamp_ntz",
    )
    assert tuple(R.iso_dates(frame).first()) == (
        1,
        "2024-01-02",
        "2024-01-02T03:04:05",
        "2024-01-02T03:04:05.000060",
    )


def test_batches_accumulate_and_repeat_safely(spark, tmp_path):
    base = str(tmp_path / "bronze")
    frame = spark.createDataFrame([(1, "Ana"), (2, "Bia")], "client_id long, full_name string")
    first, second = B.Batch.new(AT), B.Batch.new(datetime(2024, 4, 1, tzinfo=UTC))
    for batch in (first, first, second):
        report = B.ingest({"clientes": frame}, "empresa_b", base, batch)
        assert report["clientes"].rows == 2
    assert report["clientes"].path.endswith(f"empresa_b/clientes/year=2024/month=04/{second.batch_id}.parquet")
    everything = R.read_bronze(spark, base, "empresa_b", "clientes")
    assert everything.count() == 4
    assert everything.schema.names == schemas.BRONZE["empresa_b", "clientes"].names
    assert R.read_batch(spark, base, "empresa_b", "clientes", first.batch_id).count() == 2
    assert R.read_bronze(spark, base, "empresa_b", "clientes", since=(2024, 4)).count() == 2
    row = R.read_batch(spark, base, "empresa_b", "clientes", first.batch_id).first()
    assert (row["_source"], row["_ingested_at"]) == ("empresa_b", "2024-03-05T06:07:08.250000+00:00")
    files = R.list_objects(spark, base, "*.parquet")
    assert files.columns == ["path", "length", "modificationTime"]
    assert files.count() >= 2


def test_empty_batch_writes_nothing(spark, tmp_path):
    base = tmp_path / "bronze"
    empty = spark.createDataFrame([], "client_id long")
    report = B.ingest({"clientes": empty}, "empresa_b", str(base))
    assert report["clientes"] == B.Written("", 0)
    assert not base.exists()


def test_both_registries_of_a_source_share_the_batch(spark, tmp_path):
    frame = spark.createDataFrame([(" Ana",)], "Nome string")
    sources = {"empresa_d": {"clientes": frame, "fornecedores": frame}, "empresa_b": {}}
    report = B.ingest_all(sources, str(tmp_path), AT)
    names = {written.path.rsplit("/", 1)[1] for written in report["empresa_d"].values()}
    assert len(names) == 1 and len(list(B.written_paths(report.values()))) == 2


def test_union_of_different_shapes(spark):
    a = spark.createDataFrame([(1, "x@y.z")], "id long, email string")
    e = spark.createDataFrame([("u1", 2.5)], "id string, rating double")
    d = spark.createDataFrame([("X@Y.Z",)], "Email string")
    frame = R.bronze_all([a, e, d])
    assert [f.simpleString() for f in frame.schema] == ["id:string", "email:string", "rating:double"]
    assert {tuple(r) for r in frame.collect()} == {("1", "x@y.z", None), ("u1", None, 2.5), (None, "X@Y.Z", None)}


def test_jdbc_ranges_cover_the_bounds():
    options = R.jdbc_options("jdbc:x", "clientes", "id", (1, 1_000_000), 64, {"user": "u"})
    assert options == {
        "user": "u",
        "url": "jdbc:x",
        "dbtable": "clientes",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "1000000",
        "numPartitions": "64",
    }
    assert R.jdbc_options("u", "t", "id", (5, 5), 4)["upperBound"] == "6"


def test_broken_records_go_to_the_quarantine(spark, tmp_path):
    """A cut page, a line with a field too many, one with too few, and a malformed document."""
    pages, sheets, docs, base = tmp_path / "pages", tmp_path / "sheets", tmp_path / "docs", str(tmp_path / "bronze")
    for folder in (pages, sheets, docs):
        folder.mkdir()
    for page in (_page(1, True, "a", "b"), _page(2, True, "c", "d"), _page(3, False, "e")):
        text = json.dumps(page)
        (pages / f"{page['page']}.json").write_text(text[:-20] if page["page"] == 2 else text)
    head = "Nome,Documento,Fone,Email,Endereco,Obs\n"
    (sheets / "clientes.csv").write_text(head + "Ana,1,2,a@b.c,Rua,x\nBia,1,2,a@b.c,Rua,x,more\nCai,1\n")
    (sheets / "fornecedores.csv").write_text(head + "Ana,1,2,a@b.c,Rua,\n")
    (docs / "a.json").write_text('{"_id": "f1", "cnpj": "1"}\n\n{"_id": "f2", "cnpj"\n7\n')
    batch = B.Batch.new(AT, "b1")
    sources = {
        "empresa_e": B.extract_e(spark, str(pages)),
        "empresa_d": B.extract_d(spark, str(sheets)),
        "empresa_c": B.extract_c(spark, str(docs)),
    }
    report = {source: B.ingest(frames, source, base, batch) for source, frames in sources.items()}
    counts = {(s, k): (w.rows, w.quarantined) for s, frames in report.items() for k, w in frames.items()}
    assert counts == {
        # the cut page itself, and that three of five records are there
        ("empresa_e", "clientes"): (3, 2),
        ("empresa_d", "clientes"): (1, 2),
        ("empresa_d", "fornecedores"): (1, 0),
        ("empresa_c", "fornecedores"): (1, 2),
    }
    held = spark.read.option("recursiveFileLookup", True).parquet(f"{base}/_quarantine").collect()
    assert {r["_batch_id"] for r in held} == {"b1"} and len(held) == 6
    assert {r.registro for r in held if r["_source"] == "empresa_d"} == {"Bia,1,2,a@b.c,Rua,x,more", "Cai,1"}
    assert "pages hold 3 of 5 records" in {r.registro for r in held}
    assert "_corrupt" not in R.read_bronze(spark, base, "empresa_d", "clientes", every_column=True).columns
    for source, kind in (("empresa_e", "clientes"), ("empresa_d", "clientes"), ("empresa_c", "fornecedores")):
        with pytest.raises(FAILED_QUERY, match="corrupt record"):
            B.ingest({kind: sources[source][kind]}, source, f"{base}-strict", batch, strict=True)
    with pytest.raises(FAILED_QUERY, match="unreadable record"):
        R.read_documents(spark, str(docs)).collect()
    with pytest.raises(FAILED_QUERY, match="unreadable record"):
        R.read_csv_text(spark, str(sheets / "clientes.csv")).collect()
    with pytest.raises(FAILED_QUERY, match="unreadable record"):
        R.read_pages(spark, str(pages)).collect()


def test_sources_are_read_once(spark, tmp_path):
    """The landing files may go once a batch is received; every later step reads what was stored."""
    page = {"page": 1, "per_page": 9, "total": 2, "has_next": False, "data": [{"id": "a"}, {"id": "b"}]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(json.dumps(page))
    frame = B.extract_e(spark, str(tmp_path / "in"))["clientes"]
    assert "Scan text" not in frame._jdf.queryExecution().executedPlan().toString()
    reads = spark.sparkContext.accumulator(0)
    rows = spark.range(3).rdd.map(lambda r: (reads.add(1), r[0])[1:]).toDF("client_id long")
    rows = rows.withColumn(R.CORRUPT, F.when(F.col("client_id") == 2, "broken"))
    written = B.ingest({"clientes": rows}, "empresa_b", str(tmp_path / "bronze"))["clientes"]
    assert (written.rows, written.quarantined, reads.value) == (2, 1, 3)
