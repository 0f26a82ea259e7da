"""Connected groups of linked ids, and the bucket rounds that find the links.

Nothing here is gathered by the driver but counters; every table is distributed and every loop cuts
its lineage in the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from goldenrec.session import run_folder, stage


# Factor from one round's number of centres per bucket to the next.
GROWTH = 256
# Buckets of at most so many members have every pair formed that passes the cheap test.
FEW = 16


class Scratch:
    """Tables of a loop, written to the shared folder and removed together when it is done.

    Written tables cut the lineage and have true sizes; checkpointed frames keep estimated ones, which a loop
    multiplies up until planning takes longer than the work.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{run_folder(spark)}/loop-{uuid.uuid4()}"
        self.count = 0

    def saved(self, frame: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def few(self, frame: DataFrame) -> DataFrame:
        """In an eighth of the session's shuffle partitions: rows of ids, beside texts a small part."""
        return frame.coalesce(max(int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 8, 4))

    def counted(self, frame: DataFrame, what: Column) -> tuple[DataFrame, int]:
        """The table, and how many of its rows ``what`` holds for, counted while it is written."""
        seen = Observation()
        return self.saved(frame.observe(seen, F.count_if(what).alias("n"))), seen.get["n"]

    def clear(self) -> None:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, component`` for every id of ``links(a, b)``: the smallest id of its connected group.

    Each round takes the smallest label among the neighbours (combined before the shuffle, so a hub
    costs one row per task) and then the label of that label, so long chains halve every round.
    """
    both = scratch.saved(scratch.few(links.select("a", "b").union(links.select("b", "a")).distinct()))
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    labels = labels.withColumn("component", F.least("id", "component"))
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        hooked = labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("next")
        )
        target = hooked.select(F.col("id").alias("next"), F.col("next").alias("far"))
        jumped = hooked.join(target, "next").select("id", "old", F.least("next", "far").alias("component"))
        jumped, changed = scratch.counted(scratch.few(jumped), F.col("component") < F.col("old"))
        labels = jumped.select("id", "component")
        if not changed:
            return labels


def _merged(groups: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``groups`` after further ``links``: only the links between groups are followed."""
    left = groups.select(F.col("id").alias("a"), F.col("component").alias("left"))
    right = groups.select(F.col("id").alias("b"), F.col("component").alias("right"))
    between = links.join(left, "a", "left").join(right, "b", "left")
    between = between.select(F.coalesce("left", "a").alias("a"), F.coalesce("right", "b").alias("b"))
    moved = components(between.where("a <> b"), scratch)
    target = moved.select(F.col("id").alias("component"), F.col("component").alias("to"))
    old = groups.join(target, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    new = moved.join(groups, "id", "left_anti").select("id", "component")
    return scratch.saved(scratch.few(old.unionByName(new)))


def _related(
    live: DataFrame, relate: Callable[[DataFrame], DataFrame], central: Callable[[Column], Column]
) -> DataFrame:
    """``live``, its info with a ``view``: what ``relate`` tells of a member and the bucket's most central one.

    Buckets of few members have NULL there.
    """
    order = F.struct(central(F.col("info")), F.xxhash64("id"), F.col("id"))
    many = live.groupBy("bucket").agg(F.min_by("id", order).alias("centre"), F.count(F.lit(1)).alias("size"))
    many = many.where(F.col("size") > FEW).select("bucket", "centre")
    placed = live.join(many, "bucket", "left")
    views = relate(placed.where("centre is not null").select("centre", "id").distinct())
    names = [F.col(name) for name in live.columns if name != "info"]
    return placed.join(views, ["centre", "id"], "left").select(*names, F.struct("info.*", "view").alias("info"))


def star_groups(
    members: DataFrame,
    infos: DataFrame,
    close: Callable[[Column, Column], Column],
    confirm: Callable[[DataFrame], DataFrame],
    prepare: Callable[[DataFrame], None] = lambda ids: None,
    refine: Callable[[DataFrame], DataFrame] | None = None,
    central: Callable[[Column], Column] = lambda info: F.lit(0),
    relate: Callable[[DataFrame], DataFrame] | None = None,
    closer: Callable[[Column, Column], Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Connected groups of ids that share a bucket and pass ``confirm``; (groups, links).

    ``members(bucket, id)`` and ``infos(id, info)``; ``close(info, info)`` is a cheap necessary test,
    ``confirm`` takes ``pairs(a, b)`` with a < b and returns those that are links; ``prepare`` gets the ids of all
    buckets with more than one, before the first pair is confirmed. ``refine`` may give the ids that are
    left after the first round a sharper info (``id, info``): what it knows of them it may measure among
    these ids alone, since all that can still be a partner is one of them. ``relate`` gives what tells members of
    a large bucket apart by their relation to one of them: for ``stars(centre, id)`` it returns ``centre, id, view``.
    From the round of 256 centres on, info holds that view (NULL in small buckets) and ``closer`` stands for ``close``.

    Candidates are stars: in each round some members of a bucket, its centres, are compared with all
    members of other groups. One centre per bucket first, then the one with the least ``central(info)``,
    then 256, 65536, ... of those outside the bucket's largest group, until every one of these has been a
    centre. So each pair of ids in one bucket that could still join two groups is tested, pairs inside a
    group are not, and a bucket of n members around a common text costs about n pairs instead of n * n / 2.
    """
    scratch = Scratch(members.sparkSession)
    saved = scratch.saved
    range_ = members.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    shared = range_.where("low < high").select("bucket", "low")
    # info joins what is left: most ids share no bucket with another
    live = members.join(shared, "bucket").select("bucket", "low", "id").distinct()
    live = saved(live.join(infos, "id").select("bucket", "low", "id", "info"))
    prepare(live.select("id").distinct())
    info = live.where(F.col("id") == F.col("low")).select("bucket", F.col("info").alias("other"))
    star = live.where(F.col("id") > F.col("low")).join(info, "bucket").where(close(F.col("info"), F.col("other")))
    pairs = saved(scratch.few(star.select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()))
    links = saved(confirm(pairs))
    used = live.where(F.col("id") == F.col("low")).select("bucket", "id")
    live, found, sharper = live.drop("low"), [links], refine
    tested, width = [pairs], 1
    groups = components(links, scratch)
    more = True
    while more:
        placed = (
            live.drop("component")
            .join(groups, "id", "left")
            .withColumn("component", F.coalesce("component", "id"))
        )
        sizes = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"))
        largest = (
            sizes.groupBy("bucket")
            .agg(F.max(F.struct("size", "component")).alias("top"), F.count(F.lit(1)).alias("parts"))
            .where("parts > 1")
            .select("bucket", F.col("top.component").alias("main"))
        )
        live = saved(scratch.few(placed.join(largest, "bucket")))
        if sharper:
            known = sharper(live.select("id").distinct())
            live, sharper = saved(scratch.few(live.drop("info").join(known, "id"))), None
        if relate and width > 1:
            live, relate, close = saved(scratch.few(_related(live, relate, central))), None, closer or close
        # the most central one may well be in the largest group: it gathers most of the others
        pool = live if width == 1 else live.where(F.col("component") != F.col("main"))
        turn = Window.partitionBy("bucket").orderBy(central(F.col("info")), F.xxhash64("id"), "id")
        ranked = pool.join(used, ["bucket", "id"], "left_anti").withColumn("turn", F.row_number().over(turn))
        # one beyond the width tells that the bucket needs another round
        ranked = scratch.few(ranked.where(F.col("turn") <= width + 1))
        ranked, waiting = scratch.counted(ranked, F.col("turn") > width)
        centres = ranked.where(F.col("turn") <= width)
        mine = centres.select(
            "bucket",
            F.col("id").alias("centre"),
            F.col("info").alias("other"),
            F.col("component").alias("own"),
        )
        pairs = (
            live.join(mine, "bucket")
            .where((F.col("component") != F.col("own")) & close(F.col("info"), F.col("other")))
            .select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
            .distinct()
        )
        for before in tested:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs, count = scratch.counted(scratch.few(pairs), F.lit(True))
        if count:
            tested.append(pairs)
            links, count = scratch.counted(confirm(pairs), F.lit(True))
        if count:
            found.append(links)
            groups = _merged(groups, links, scratch)
        used = used.unionAll(centres.select("bucket", "id"))
        if width > 1:
            # a bucket whose outside members all had their turn is done, whatever its groups become
            more = waiting > 0
            live = live.join(ranked.where(F.col("turn") > width).select("bucket"), "bucket", "left_semi")
        live = live.drop("main")
        width *= GROWTH
    result = stage(groups, "groups"), stage(reduce(DataFrame.unionAll, found), "links")
    scratch.clear()
    return result
