"""Exact positions in a global order, pages of any depth, and page envelopes."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenrec.plans import versions
from goldenrec.session import checkpoint_dir

# Pages that end above this row are cut from ranked keys instead of a top-n on the driver side.
TOP_N_LIMIT = 10_000
_PARTITION_BITS = 33
# Rows of a stored range.
RANGE_ROWS = 1_000_000


def global_position(frame: DataFrame, *order: Column) -> DataFrame:
    """``frame`` plus ``posicao`` = 1, 2, 3, ... in the given order, which must be unique.

    A distributed sort numbers the rows inside each range; the sizes of the earlier ranges give the
    rest. The sorted rows are written once so both passes see the same ranges, and there is no
    window over the whole table.
    """
    checkpoint_dir(frame.sparkSession)
    tagged = frame.sort(*order).withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    ranges = F.shiftright("_row", _PARTITION_BITS)
    # one row per range: as many as the sort has partitions
    sizes = sorted(tagged.groupBy(ranges.alias("range")).count().collect())
    before, offsets = 0, []
    for number, size in sizes:
        offsets.append((number, before))
        before += size
    table = frame.sparkSession.createDataFrame(offsets, "_range bigint, _before bigint")
    inside = F.col("_row").bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    return (
        tagged.join(F.broadcast(table), ranges == F.col("_range"))
        .withColumn("posicao", inside + F.col("_before") + 1)
        .drop("_row", "_range", "_before")
    )


def in_order(name: str, descending: bool = False) -> Column:
    """Sort key with NULLs last in both directions."""
    return F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_last()


def page_of(
    frame: DataFrame, page: int, per_page: int, key: str, order: list[tuple[str, bool]]
) -> DataFrame:
    """Rows of one page by ``order`` (name, descending), ties by the unique ``key``.

    Early pages are a distributed top-n; later ones rank only the ordering columns and fetch the
    page's rows by key, so a deep page never gathers the pages before it.
    """
    sort = [in_order(name, descending) for name, descending in [*order, (key, False)]]
    offset = (page - 1) * per_page
    if offset + per_page <= TOP_N_LIMIT:
        return frame.orderBy(*sort).offset(offset).limit(per_page)
    ranked = global_position(frame.select(key, *[name for name, _ in order]), *sort)
    wanted = ranked.where(F.col("posicao").between(offset + 1, offset + per_page)).select(
        F.col(key).alias("_key"), "posicao"
    )
    # at most per_page rows
    rows = frame.join(F.broadcast(wanted), F.col(key).eqNullSafe(F.col("_key")))
    return rows.orderBy("posicao").drop("_key", "posicao")


class Ranked:
    """A table stored in rank order: ranges of rows in folders, and how many rows lie before each range.

    Built once for an order; a page then reads and sorts the one or two ranges it lies in, however deep it is.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        version = versions.current(spark, root)
        if version is None:
            raise FileNotFoundError(f"no ranked table in {root}")
        self.folders, self.notes = version.folders, version.notes
        counts = spark.read.parquet(f"{self.root}/{self.folders['ranges'][0]}").orderBy("faixa").collect()
        # one entry a range
        self.starts, self.total = [], 0
        for row in counts:
            self.starts.append((row.faixa, self.total, self.total + row.n))
            self.total += row.n

    @staticmethod
    def build(
        frame: DataFrame, root: str, key: str, order: list[tuple[str, bool]], range_rows: int = RANGE_ROWS
    ) -> Ranked:
        """Store ``frame`` by ``order`` (name, descending), ties by the unique ``key``, in place of what ``root`` held."""
        spark, root = frame.sparkSession, root.rstrip("/")
        before = versions.current(spark, root)
        rows, ranges = versions.new_folder(before), versions.new_folder(before)
        sort = [in_order(name, descending) for name, descending in [*order, (key, False)]]
        number = max(1, -(-frame.count() // range_rows))
        # the key parts a leading value that many rows share
        placed = frame.repartitionByRange(number, *sort).withColumn("faixa", F.spark_partition_id())
        placed.sortWithinPartitions("faixa", *sort).write.partitionBy("faixa").parquet(f"{root}/{rows}")
        stored = spark.read.schema(placed.schema).parquet(f"{root}/{rows}")
        counts = stored.groupBy("faixa").agg(F.count(F.lit(1)).alias("n"))
        counts.coalesce(1).write.parquet(f"{root}/{ranges}")
        notes = {"key": key, "order": order, "schema": frame.schema.json()}
        versions.commit(spark, root, {"rows": [rows], "ranges": [ranges]}, notes, after=before.number if before else 0)
        versions.clean(spark, root)
        return Ranked(spark, root)

    def page(self, page: int, per_page: int) -> DataFrame:
        """Rows of one page in order: the same as ``page_of``."""
        first = (page - 1) * per_page
        hit = [(faixa, start) for faixa, start, end in self.starts if start < first + per_page and end > first]
        schema = T.StructType.fromJson(json.loads(self.notes["schema"]))
        names = schema.fieldNames()
        rows = self.spark.read.schema(schema.add("faixa", T.IntegerType())).parquet(f"{self.root}/{self.folders['rows'][0]}")
        sort = [in_order(name, descending) for name, descending in [*self.notes["order"], (self.notes["key"], False)]]
        own = rows.where(F.col("faixa").isin([faixa for faixa, _ in hit]))
        skipped = first - hit[0][1] if hit else 0
        return own.orderBy(*sort).offset(skipped).limit(per_page).select(names)


def page_envelopes(frame: DataFrame, key: str, per_page: int) -> DataFrame:
    """The whole table as pages ``page, per_page, total, has_next, data[]`` in key order."""
    records = [name for name in frame.columns]
    placed = global_position(frame, in_order(key))
    # counted on the stored order, not on the source again
    total = placed.count()
    page = F.ceil(F.col("posicao") / per_page).cast("bigint")
    entry = F.struct("posicao", F.struct(*records).alias("record"))
    pages = placed.groupBy(page.alias("page")).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["record"]).alias("data")
    )
    return pages.select(
        "page",
        F.lit(per_page).cast("bigint").alias("per_page"),
        F.lit(total).cast("bigint").alias("total"),
        (F.col("page") * per_page < total).alias("has_next"),
        "data",
    )
