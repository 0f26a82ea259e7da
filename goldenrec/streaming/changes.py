"""A change feed: the newest row per key over a stream, in whatever order rows arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from goldenrec.plans import versions
from goldenrec.streaming.tables import ROW, in_any, read_layers, write_layer

TABLE, EVENTS = "table", "events"
# What an event does to its key.
INSERT, UPDATE = "insert", "update"
# The state of all keys is on the executors' disks, not in their memory.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _rank(schema: T.StructType, keys: list[str], order: str, then: tuple[str, ...]) -> list[str]:
    """All columns by weight, as ``latest_per_key`` weighs them: order, ties, payload by name."""
    first = [order, *(name for name in then if name in schema.fieldNames())]
    return first + sorted(name for name in schema.fieldNames() if name not in (*keys, *first))


def _row_key(keys: list[str]) -> Column:
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})


def newest_in_stream(
    stream: DataFrame, keys: list[str], order: str = "_ingested_at", then: tuple[str, ...] = ("_batch_id",)
) -> DataFrame:
    """Newest row per key of a streaming table, for update mode: a key appears whenever rows of it arrive.

    The state holds one row a key; tasks combine their rows before the shuffle. A late row loses against the stored
    one by its ``order``, so the order of arrival makes no difference.
    """
    ranked = F.struct(*_rank(stream.schema, keys, order, then))
    newest = stream.groupBy(*keys).agg(F.max(ranked).alias("_newest"))
    return newest.select(*[name if name in keys else F.col("_newest")[name].alias(name) for name in stream.columns])


def _store(root: str, schema: T.StructType, keys: list[str], order: str, horizon: str):
    """Writes one micro-batch as events and as a layer of the table, both under one version."""

    def run(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        version = versions.current(spark, root)
        notes = version.notes if version else {"batch": -1, "seen": None}
        if batch <= notes["batch"]:
            return
        held = version.folders.get(TABLE, []) if version else []
        # a repeated micro-batch finds the folders of the failed one unnamed and writes its own
        folder = versions.new_folder(version)
        found = rows.withColumn(ROW, _row_key(keys))
        old = in_any(read_layers(spark, root, held, schema), found.select(ROW), ROW)
        names = schema.fieldNames()
        before = old.select(ROW, F.struct(*names).alias("before"))
        joined = found.join(before, ROW, "left")
        changed = joined.where(~F.struct(*names).eqNullSafe(F.col("before")))
        late = F.lit(False)
        if notes["seen"]:
            late = F.coalesce(
                F.col(order).cast("timestamp") < F.lit(notes["seen"]).cast("timestamp") - F.expr(f"interval {horizon}"), late
            )
        events = changed.select(
            *names,
            ROW,
            F.when(F.col("before").isNull(), INSERT).otherwise(UPDATE).alias("op"),
            late.alias("atrasado"),
            F.lit(batch).cast("long").alias("lote"),
        )
        events.write.parquet(f"{root}/{folder}")
        events = spark.read.schema(events.schema).parquet(f"{root}/{folder}")
        newest = events.agg(F.max(F.col(order).cast("string"))).first()[0]
        folders = dict(version.folders) if version else {}
        folders[EVENTS] = [*folders.get(EVENTS, []), folder]
        folders[TABLE] = write_layer(events.select(*names, ROW), None, root, version, held)
        seen = max(filter(None, (notes["seen"], newest)), default=None)
        versions.commit(spark, root, folders, {"batch": batch, "seen": seen}, after=version.number if version else 0)
        versions.clean(spark, root)

    return run


def start_feed(
    stream: DataFrame,
    root: str,
    keys: list[str],
    *,
    order: str = "_ingested_at",
    then: tuple[str, ...] = ("_batch_id",),
    horizon: str = "7 days",
    **trigger: object,
) -> StreamingQuery:
    """Follow a streaming table with instants as ISO text or timestamps in ``order``; trigger options as Spark names them.

    Every change of a key's newest row becomes one event, ``insert`` or ``update``; rows that change nothing become
    none. An event whose row is older than the newest load seen before it, less ``horizon``, is marked ``atrasado``.
    NULL keys are one key. A micro-batch that is repeated after a failure counts once.
    """
    spark, root = stream.sparkSession, root.rstrip("/")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    writer = newest_in_stream(stream, keys, order, then).writeStream.outputMode("update")
    return (
        writer.foreachBatch(_store(root, stream.schema, keys, order, horizon))
        .option("checkpointLocation", f"{root}/_stream")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def feed_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The newest row of every key, as of the last complete micro-batch."""
    root = root.rstrip("/")
    version = versions.current(spark, root)
    return read_layers(spark, root, version.folders[TABLE] if version else [], schema).drop(ROW)


def feed_events(spark: SparkSession, root: str, schema: T.StructType, after: int = -1) -> DataFrame:
    """All events after micro-batch ``after``: the row, ``op``, ``atrasado`` and ``lote``."""
    root = root.rstrip("/")
    version = versions.current(spark, root)
    kinds = (("op", T.StringType()), ("atrasado", T.BooleanType()), ("lote", T.LongType()))
    wide = T.StructType([*schema.fields, *(T.StructField(name, kind) for name, kind in kinds)])
    folders = version.folders[EVENTS] if version else []
    if not folders:
        return spark.createDataFrame([], wide)
    return spark.read.schema(wide).parquet(*[f"{root}/{folder}" for folder in folders]).where(F.col("lote") > after)
