"""Incremental gold against a full rebuild over everything received so far."""

import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenrec.operators.golden import build_golden
from goldenrec.operators.resolve import resolve_entities
from goldenrec.operators.standardize import SPECS, standardize, union_registry
from goldenrec.plans import queries, versions
from goldenrec.schemas import BRONZE
from goldenrec.sources.bronze import Batch, batch_path
from goldenrec.sources.readers import read_bronze
from goldenrec.streaming import incremental, tables
from goldenrec.streaming.incremental import GOLDEN, RECORDS, advance, incremental_table, receive, registry_root, touched_rows
from helpers import RUN_TS, as_set

DOCS = ["11144477735", "52998224725", "00012587033", "12345678901", None, ""]
MAILS = ["a@x.com", "b@x.com", "c@x.com", None]


def rows_of(key, rng, count, when, batch):
    rows = []
    for _ in range(count):
        values = dict.fromkeys(BRONZE[key].fieldNames())
        number = rng.randint(1, 12)
        if key[0] == "empresa_a":
            values |= {"id": number, "cpf_cnpj": rng.choice(DOCS), "email": rng.choice(MAILS), "nome_razao_social": f"n{rng.randint(1, 3)}"}
        elif key[0] == "empresa_b":
            values |= {"client_id": number, "email": rng.choice(MAILS), "full_name": f"m{rng.randint(1, 3)}"}
        else:
            values |= {"Documento": rng.choice(DOCS), "Nome": f"x{rng.randint(1, 4)}", "Email": rng.choice(MAILS)}
        values |= {"_source": key[0], "_ingested_at": when.isoformat(), "_batch_id": batch}
        rows.append(tuple(values.values()))
    return rows


def land(spark, base, key, rows, when, batch):
    path = batch_path(f"{base}/bronze", *key, Batch(batch, when))
    spark.createDataFrame(rows, BRONZE[key]).coalesce(2).write.parquet(path)


def full(spark, base, registry):
    parts = [standardize(read_bronze(spark, f"{base}/bronze", *key), spec, RUN_TS) for key, spec in SPECS.items() if key[1] == registry]
    clustered = resolve_entities(union_registry(parts))
    return clustered, build_golden(clustered, RUN_TS)


KEYS = [("empresa_a", "clientes"), ("empresa_b", "clientes"), ("empresa_d", "clientes")]


@pytest.mark.parametrize("seed", [1])
def test_three_batches_equal_a_full_rebuild(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(tables, "LAYERS", 2)
    rng, base = random.Random(seed), str(tmp_path)
    for turn in range(3):
        # the second batch comes late: it was loaded before the first
        when = datetime(2024, 3, (2, 1, 3)[turn], tzinfo=UTC)
        for key in KEYS[: 2 + turn % 2]:
            land(spark, base, key, rows_of(key, rng, 14 - 4 * turn, when, f"b{turn}"), when, f"b{turn}")
        done = advance(spark, base, RUN_TS)["clientes"]
        assert done.version == turn + 1 and done.clusters > 0
        clustered, golden = full(spark, base, "clientes")
        assert as_set(incremental_table(spark, base, "clientes", RECORDS)) == as_set(clustered)
        assert as_set(incremental_table(spark, base, "clientes")) == as_set(golden)
    assert advance(spark, base, RUN_TS) == {"clientes": (3, 0), "fornecedores": (0, 0)}


def customer(spark, base, number, doc, mail, when, batch):
    key = ("empresa_a", "clientes")
    values = dict.fromkeys(BRONZE[key].fieldNames())
    values |= {"id": number, "cpf_cnpj": doc, "email": mail, "_ingested_at": when.isoformat(), "_batch_id": batch}
    land(spark, base, key, [tuple(values.values())], when, batch)


def test_owner_changes_reach_the_followers_and_nobody_else(spark, tmp_path):
    base, key = str(tmp_path), ("empresa_b", "clientes")
    day = [datetime(2024, 3, d, tzinfo=UTC) for d in range(1, 5)]
    plain = dict.fromkeys(BRONZE[key].fieldNames())
    followers = [tuple((plain | {"client_id": i, "email": m, "_ingested_at": day[0].isoformat()}).values()) for i, m in ((1, "a@x.com"), (2, "b@x.com"), (3, None))]
    land(spark, base, key, followers, day[0], "f")
    customer(spark, base, 7, "52998224725", "b@x.com", day[0], "p")
    advance(spark, base, RUN_TS)
    # a new owner of a@x.com: the follower's own cluster ends, the others stay as they are
    customer(spark, base, 8, "11144477735", "a@x.com", day[1], "q")
    advance(spark, base, day[1])
    rows = {r["_row"]: r["_gone"] for r in touched_rows(spark, base, "clientes").collect()}
    assert len(rows) == 2 and rows["doc:11144477735"] is False
    ended = next(k for k, gone in rows.items() if gone)
    assert ended.startswith("lone:")
    gold = incremental_table(spark, base, "clientes")
    assert gold.where("cluster_key = 'doc:11144477735'").first().total_fontes == 2
    stamps = {r.cluster_key: r._processed_at for r in gold.collect()}
    assert {key: stamp.day for key, stamp in stamps.items() if key.startswith("doc:")} == {"doc:52998224725": 1, "doc:11144477735": 2}
    # the owner leaves the address again
    customer(spark, base, 8, "11144477735", "z@x.com", day[2], "r")
    advance(spark, base, day[2])
    assert as_set(incremental_table(spark, base, "clientes"), "_processed_at") == as_set(full(spark, base, "clientes")[1], "_processed_at")
    assert incremental_table(spark, base, "clientes").where(F.col("cluster_key") == ended).count() == 1


def test_a_run_that_fails_is_repeated_whole(spark, tmp_path, monkeypatch):
    base, day = str(tmp_path), datetime(2024, 3, 1, tzinfo=UTC)
    customer(spark, base, 1, "52998224725", "b@x.com", day, "p")
    with monkeypatch.context() as broken:
        broken.setattr(versions, "commit", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            advance(spark, base, RUN_TS)
    assert versions.current(spark, registry_root(base, "clientes")) is None
    # received, but not counted: the next run takes it up, and a second stream run brings nothing twice
    receive(spark, base, SPECS["empresa_a", "clientes"])
    assert advance(spark, base, RUN_TS)["clientes"] == (1, 1)
    assert incremental_table(spark, base, "clientes").count() == 1
    assert versions.current(spark, registry_root(base, "clientes")).folders[GOLDEN][0].startswith("v1-")


def test_rows_are_not_stored_once_more_beside_their_layers(spark, tmp_path, monkeypatch):
    base, day, stored = str(tmp_path), datetime(2024, 3, 1, tzinfo=UTC), []
    land(spark, base, KEYS[1], rows_of(KEYS[1], random.Random(3), 30, day, "p"), day, "p")

    def counting(frame, name):
        stored.append((name, (kept := store(frame, name)).count()))
        return kept

    store = incremental.stage
    monkeypatch.setattr(incremental, "stage", counting)
    advance(spark, base, RUN_TS)
    rows = incremental_table(spark, base, "clientes", RECORDS).count()
    # received, standardised, keys of the touched clusters, their members
    assert rows > 9 and sum(count for _, count in stored) <= 4 * rows


def test_empty_lake(spark, tmp_path):
    assert advance(spark, str(tmp_path), RUN_TS) == {"clientes": (0, 0), "fornecedores": (0, 0)}
    assert incremental_table(spark, str(tmp_path), "fornecedores").count() == 0


def test_of_rows_loaded_at_once_the_greatest_stays_whenever_it_came(spark, tmp_path):
    base, key, day = str(tmp_path), ("empresa_a", "clientes"), datetime(2024, 3, 1, tzinfo=UTC)
    plain = dict.fromkeys(BRONZE[key].fieldNames()) | {"_ingested_at": day.isoformat(), "_batch_id": "b"}
    for turn, names in enumerate([("b", "a", "c"), ("a", "b", "c")]):
        rows = [tuple((plain | {"id": number, "nome_razao_social": name}).values()) for number, name in enumerate(names)]
        land(spark, base, key, rows, day, f"part{turn}")
        advance(spark, base, RUN_TS)
    assert as_set(incremental_table(spark, base, "clientes")) == as_set(full(spark, base, "clientes")[1])
    # the equal row and the smaller one are no change
    assert touched_rows(spark, base, "clientes").count() == 1


def test_no_layers_are_no_input(spark):
    nothing = tables.read_layers(spark, "/nowhere", [], BRONZE["empresa_a", "clientes"])
    keys = spark.range(5).select(F.col("id").cast("string").alias(tables.ROW))
    text = nothing.join(keys, tables.ROW)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Exchange" not in text
    assert nothing.columns == [*BRONZE["empresa_a", "clientes"].fieldNames(), tables.ROW]


@pytest.mark.parametrize("layers", [1, 2, 3, 5])
def test_layers_are_read_as_their_newest_rows(spark, tmp_path, layers):
    rng, live, folders, root = random.Random(layers), {}, [], str(tmp_path)
    schema = T.StructType([T.StructField("v", T.LongType())])
    for number in range(1, layers + 1):
        rows = {str(key): None if rng.random() < 0.2 else number for key in rng.sample(range(12), 7)}
        live |= rows
        folders.append(f"v{number}")
        written = [(v, key, number, v is None) for key, v in rows.items()]
        spark.createDataFrame(written, tables.layered(schema)).write.parquet(f"{root}/v{number}")
    found = {r[tables.ROW]: r.v for r in tables.read_layers(spark, root, folders, schema).collect()}
    assert found == {key: v for key, v in live.items() if v is not None}


def test_sources_of_the_batches_are_derived_once(spark, tmp_path, monkeypatch):
    sf, calls, turns = "/root/testdata/sf0.001", [], []
    whole = {key: queries.derive_registry(spark, sf, *key) for key in SPECS if key[1] == "clientes"}

    def counting(spark, folder, *key):
        calls.append(key)
        return whole[key]

    def landed(spark, base, run_ts):
        turns.append({key: read_bronze(spark, f"{base}/bronze", *key) for key in whole})

    monkeypatch.setattr(queries, "derive_registry", counting)
    monkeypatch.setattr(queries, "advance", landed)
    queries.incremental_gold(spark, sf)
    assert sorted(calls) == sorted(whole) and len(turns) == 3
    for key, rows in whole.items():
        place = F.pmod(F.xxhash64(*rows.columns), F.lit(3))
        for turn, bronze in enumerate(turns):
            found = bronze[key].select(rows.columns)
            assert found.exceptAll(rows.where(place <= turn)).isEmpty() and found.count() == rows.where(place <= turn).count()
