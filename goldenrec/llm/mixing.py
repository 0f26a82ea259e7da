"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions alone.

Slot i of the schedule has the point i * golden ratio modulo 1. The points fall into the sources'
shares, so that any stretch of the schedule has nearly the wanted mix; the k-th slot of a source takes
the k-th block of its documents, shuffled and cut into blocks of equal words, from the start again when
all are used. Each block is taken three times at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenrec.session import stage

# Weights of the sources in order, repeating; no source is repeated more often than PASSES times.
WEIGHTS = (1, 2, 3)
PASSES = 3
# Words of a block; a small source has blocks of 1/256 of its words, at least one word.
BLOCK_WORDS = 32
BLOCKS_LEAST = 256
# Golden ratio, conjugate, in 40-bit fixed point (odd, so the points do not repeat before 2**40 slots).
POINT_BITS = 40
GOLDEN = 679535556991
# Ranges into which points are sorted to find their source: 2**10.
CELL_BITS = 10
# Slots of one stretch and hash ranges of one source: ranks are counted per stretch and added up.
STRETCH = 1 << 16
SHUFFLE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target, block, blocks, slots`` of ``sizes(source, size)`` rows.

    Sources in code point order, NULL last, have the weights 1, 2, 3 in turn and share all words. A
    target stops at three times its source; what is left over goes to the others by weight until none is
    above. That is one level times weight, capped: sources reach their cap in the order of cap / weight.
    One row per source; the windows run over those rows alone.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.orderBy(F.col("source").isNull(), "source")
    number = F.row_number().over(everything) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (number % len(WEIGHTS)).cast("int") + 1)
    ranked = totals.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * PASSES)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # level if this source and all later ones stay below their caps
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = ranked.withColumns({"left": left, "weights_left": weights_left})
    capped = F.col("cap") * F.col("weights_left") < F.col("left") * F.col("weight")
    ranked = ranked.withColumn("open", ~capped).withColumn("place", F.row_number().over(by_ratio))
    first = F.min(F.when(F.col("open"), F.struct("place", "left", "weights_left"))).over(whole)
    ranked = ranked.withColumn("level", first)
    share = F.col("weight") * F.col("level.left") / F.col("level.weights_left")
    target = F.when(F.col("place") < F.col("level.place"), F.col("cap").cast("double")).otherwise(share)
    block = F.greatest(F.least(F.floor(F.col("source_size") / BLOCKS_LEAST), F.lit(BLOCK_WORDS)), F.lit(1))
    return (
        ranked.withColumn("target", F.coalesce(target.cast("double"), F.lit(0.0)))
        .withColumn("block", block.cast("long"))
        .withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long"))
        .withColumn("slots", F.col("target") / F.col("block"))
        .select("source", "source_size", "target", "block", "blocks", "slots")
    )


def _point(slot: Column) -> Column:
    """slot * GOLDEN modulo 2**40, in two halves that stay within 64 bits."""
    half, mask = 1 << (POINT_BITS // 2), (1 << POINT_BITS) - 1
    low = slot.bitwiseAND(F.lit(half - 1)) * GOLDEN
    high = (F.shiftright(slot, POINT_BITS // 2).bitwiseAND(F.lit(half - 1)) * GOLDEN).bitwiseAND(F.lit(half - 1))
    return (low + high * half).bitwiseAND(F.lit(mask))


def schedule(targets: DataFrame) -> DataFrame:
    """``slot, source, rank, number, pass``: which block of which source each slot takes.

    ``rank`` counts the slots of a source before this one, ``number`` is the block and ``pass`` how often
    it was taken before. Slots beyond the last pass of a source take nothing and are left out.
    """
    spark = targets.sparkSession
    order = Window.orderBy(F.col("source").isNull(), "source")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scale = float(1 << POINT_BITS)
    edge = F.floor(F.sum("slots").over(upto) / F.sum("slots").over(whole) * scale).cast("long")
    shares = targets.where(F.col("slots") > 0).withColumn("upper", edge)
    shares = shares.withColumn("lower", F.lag("upper", 1, 0).over(order)).where("lower < upper")
    size = POINT_BITS - CELL_BITS
    cells = F.sequence(F.shiftright("lower", size), F.shiftright(F.col("upper") - 1, size))
    shares = shares.withColumn("cell", F.explode(cells)).select("source", "blocks", "lower", "upper", "cell")
    count = targets.agg(F.ceil(F.sum("slots")).cast("long").alias("n")).first().n or 0
    slots = spark.range(count).select(F.col("id").alias("slot"), _point(F.col("id")).alias("point"))
    slots = slots.withColumn("cell", F.shiftright("point", size))
    inside = (F.col("lower") <= F.col("point")) & (F.col("point") < F.col("upper"))
    placed = slots.join(shares, "cell").where(inside).select(
        "slot", "source", "blocks", F.floor(F.col("slot") / STRETCH).alias("stretch")
    )
    counts = placed.groupBy("source", "stretch").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("source").alias("_source"),
        F.col("stretch").alias("_stretch"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("stretch") == F.col("_stretch"))
    within = Window.partitionBy("source", "stretch").orderBy("slot")
    rank = F.row_number().over(within) - 1 + F.col("before")
    ranked = placed.join(counts, same).withColumn("rank", rank.cast("long"))
    return ranked.where(F.col("rank") < PASSES * F.col("blocks")).select(
        "slot",
        "source",
        "rank",
        (F.col("rank") % F.col("blocks")).alias("number"),
        F.floor(F.col("rank") / F.col("blocks")).cast("int").alias("pass"),
    )


def _shuffled(sizes: DataFrame) -> DataFrame:
    """Adds ``begin``: words of the same source before this row in shuffled order."""
    shuffle = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    hashed = sizes.withColumn("_hash", shuffle).withColumn("_range", F.substring("_hash", 1, SHUFFLE_DIGITS))
    sums = hashed.groupBy("source", "_range").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("_source"),
        F.col("_range").alias("_place"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"),
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_place"))
    within = Window.partitionBy("source", "_range").orderBy("_hash", "doc_id", "size")
    own = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        hashed.withColumn("_own", own)
        .join(sums, same)
        .withColumn("begin", F.col("_before") + F.col("_own") - F.col("size"))
        .drop("_hash", "_range", "_own", "_source", "_place", "_before")
    )


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row of ``docs(doc_id, source, text)``.

    ``size`` counts words (runs of characters other than space and 0x09-0x0D), ``taken`` those that the
    mix takes, repeats counted: for each block of the schedule the words of the document in it. The
    order of documents within a source is that of md5(doc_id), so reruns agree.

    NULL text: size 0, taken 0. NULL source: a source of its own, the last. NULL doc_id: shuffled as ''.
    Rows repeating a doc_id are documents each, next to each other in the order of size. Other columns
    are ignored.
    """
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sizes = stage(sizes, "mix-sizes")
    targets = source_targets(sizes)
    times = schedule(targets).groupBy("source", "number").agg(F.count(F.lit(1)).alias("times"))
    times = times.select(F.col("source").alias("_from"), F.col("number").alias("_number"), "times")
    facts = targets.select(F.col("source").alias("_known"), "source_size", "target", "block")
    known = F.col("source").eqNullSafe(F.col("_known"))
    names = ["doc_id", "source", "size", "source_size", "target"]
    empty = sizes.where("size = 0").join(facts, known).select(*names, F.lit(0).cast("long").alias("taken"))
    placed = _shuffled(sizes.where("size > 0")).join(facts, known)
    first, last = F.floor(F.col("begin") / F.col("block")), F.floor((F.col("begin") + F.col("size") - 1) / F.col("block"))
    pieces = placed.withColumn("number", F.explode(F.sequence(first, last)))
    low = F.greatest(F.col("begin"), F.col("number") * F.col("block"))
    high = F.least(F.col("begin") + F.col("size"), (F.col("number") + 1) * F.col("block"))
    same = F.col("source").eqNullSafe(F.col("_from")) & (F.col("number") == F.col("_number"))
    joined = pieces.withColumn("words", high - low).join(times, same, "left")
    # begin tells rows of one source apart: their words do not overlap
    taken = joined.groupBy(*names, "begin").agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
    return taken.select(*names, "taken").unionByName(empty)
