"""The change feed against the newest row per key over the same rows."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from goldenrec.operators.latest import latest_per_key
from goldenrec.plans import queries
from goldenrec.session import run_folder
from goldenrec.streaming import tables
from goldenrec.streaming.changes import feed_events, feed_table, start_feed
from helpers import as_set

SCHEMA = "k long, name string, value double, _ingested_at string, _batch_id string"


def rows():
    rng = random.Random(4)
    found = []
    for _ in range(120):
        day = rng.randint(1, 28)
        found.append((rng.choice([None, *range(12)]), rng.choice(["a", "b", None]), rng.choice([1.0, None]), f"2024-01-{day:02d}T00:00:00+00:00", rng.choice(["x", "y"])))
    return found + found[:10]


def follow(spark, folder, root):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(str(folder))
    query = start_feed(stream, str(root), ["k"])
    query.awaitTermination()
    return stream.schema


@pytest.mark.parametrize("seed", [0, 1])
def test_any_order_of_arrival(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(tables, "LAYERS", 3)
    given = rows()
    random.Random(seed).shuffle(given)
    landing, root = tmp_path / "in", tmp_path / "feed"
    for part in range(4):
        spark.createDataFrame(given[part * 30 : part * 30 + 40], SCHEMA).coalesce(1).write.mode("append").parquet(str(landing))
        if part in (1, 3):
            schema = follow(spark, landing, root)
    everything = spark.read.schema(SCHEMA).parquet(str(landing))
    wanted = latest_per_key(everything, ["k"])
    assert as_set(feed_table(spark, str(root), schema)) == as_set(wanted)
    events = feed_events(spark, str(root), schema).collect()
    # replaying the events gives the table again, and no event repeats what was known
    state = {}
    for event in sorted(events, key=lambda e: e.lote):
        row = (event.name, event.value, event._ingested_at, event._batch_id)
        assert (event.op == "insert") == (event.k not in state) and state.get(event.k) != row
        if event.k in state:
            assert event._ingested_at >= state[event.k][2]
        state[event.k] = row
    assert {(k, *row) for k, row in state.items()} == {tuple(r) for r in wanted.select(*schema.names).collect()}


def test_late_rows_lose_and_new_keys_that_are_late_are_told(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "feed")

    def land(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        return follow(spark, landing, root)

    land((1, "new", 1.0, "2024-03-20T00:00:00+00:00", "b"))
    land((1, "old", 1.0, "2024-03-01T00:00:00+00:00", "a"), (2, "late", 1.0, "2024-03-01T00:00:00+00:00", "a"))
    schema = land((3, "in time", 1.0, "2024-03-19T00:00:00+00:00", "c"), (1, "new", 1.0, "2024-03-20T00:00:00+00:00", "b"))
    events = {(e.k, e.name, e.op, e.atrasado) for e in feed_events(spark, root, schema).collect()}
    assert events == {(1, "new", "insert", False), (2, "late", "insert", True), (3, "in time", "insert", False)}
    assert [e.k for e in feed_events(spark, root, schema, after=1).collect()] == [3]


def test_before_the_first_row(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert feed_table(spark, str(tmp_path), schema).count() == 0
    assert feed_events(spark, str(tmp_path), schema).count() == 0


def test_events_of_one_month_come_in_files_of_bounded_size(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    events = queries.table(spark, folder, "events")
    monkeypatch.setattr(queries, "TASK_ROWS", 50)
    feeds = f"{run_folder(spark).removeprefix('file:')}/feed-*"
    known = set(glob.glob(feeds))
    newest = queries.change_feed(spark, folder)
    wanted = latest_per_key(events, ["user_id"], "ts", ()).select(newest.columns)
    assert as_set(newest) == as_set(wanted)
    (feed,) = set(glob.glob(feeds)) - known
    landed = spark.read.parquet(f"{feed}/in")
    assert landed.count() == events.count()
    assert landed.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] < events.count() / 4
