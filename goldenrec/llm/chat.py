"""Chat formatting as a prefix tree: shared initial turns once, in depth-first order.

A node is a turn together with all turns before it, so conversations with equal first turns share
nodes. Conversations sorted by their path of nodes visit the tree depth first: each one adds the nodes
that no earlier one has. One token is one character here; every node gets its place in the packed
sequence of its tree, the position its first character has in the conversation, and the intervals of the
packed sequence that it may attend to, those of its ancestors and its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenrec.session import stage

# Marks of the template. Nothing in a text can look like one: the signs they begin with are escaped.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ESCAPES = (("\\", "\\\\"), ("<", "\\("), ("[", "\\{"))
# The texts of this role are what a model learns to say.
LEARNED = "assistant"

TURNS = "conv_id long, k long, node string, parent string, tree string, role string, text string, position long"
SPANS = "conv_id long, k long, node string, position long, start long, attend array<struct<first:long,last:long>>"
BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    for sign, spelled in ESCAPES:
        text = text.replace(sign, spelled)
    return text


def unescape(text: str) -> str:
    plain = {spelled[1]: sign for sign, spelled in ESCAPES}
    parts = text.split("\\")
    found, place = [parts[0]], 1
    while place < len(parts):
        if parts[place]:
            found.append(plain[parts[place][0]] + parts[place][1:])
            place += 1
        else:  # an escaped backslash leaves an empty part before what follows it
            found.append("\\" + (parts[place + 1] if place + 1 < len(parts) else ""))
            place += 2
    return "".join(found)


def format_turn(role: str, text: str) -> str:
    return f"{TURN}{escape(role)}{TEXT}{escape(text)}{END}"


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    role, _, text = formatted[len(TURN) : -len(END)].partition(TEXT)
    return unescape(role), unescape(text)


class Tree(NamedTuple):
    """``nodes``: one row per distinct node. ``paths``: conv_id, k and node of every turn.

    Nodes have ``node, parent, tree, role, start, position, formatted, learned, attend``: ``start`` in the
    tree's packed sequence, ``learned`` the range of the formatted characters under the loss mask
    (NULL: none), ``attend`` the intervals (first, last + 1) of the packed sequence.
    """

    nodes: DataFrame
    paths: DataFrame


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _emit(rows: list[list], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
    arrays = [pa.array(list(column), kind) for column, (_, kind) in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in kinds])


_TEXT, _LONG = pa.string(), pa.int64()
_TURN_KINDS = list(
    zip(
        ["conv_id", "k", "node", "parent", "tree", "role", "text", "position"],
        [_LONG, _LONG, _TEXT, _TEXT, _TEXT, _TEXT, _TEXT, _LONG],
        strict=True,
    )
)
_SPAN_KINDS = [
    ("conv_id", _LONG),
    ("k", _LONG),
    ("node", _TEXT),
    ("position", _LONG),
    ("start", _LONG),
    ("attend", pa.list_(pa.struct([("first", _LONG), ("last", _LONG)]))),
]
_BACK_KINDS = list(
    zip(
        ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        [_LONG, _LONG, _TEXT, _LONG, _TEXT, _LONG],
        strict=True,
    )
)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes along each conversation; rows come sorted, a conversation may span many batches."""
    current: object = object()
    node = parent = tree = ""
    k = position = 0
    for batch in batches:
        found = []
        for conv, role, text in _rows(batch):
            if conv != current:
                current, node, k, position = conv, "", 0, 0
            parent = node
            own = hashlib.sha256()
            for part in (parent, role, text):
                data = part.encode()
                own.update(len(data).to_bytes(8, "little"))
                own.update(data)
            node = own.hexdigest()[:32]
            tree = node if k == 0 else tree
            found.append([conv, k, node, parent, tree, role, text, position])
            k += 1
            position += len(format_turn(role, text))
        yield _emit(found, _TURN_KINDS)


def _attend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Attention intervals along each conversation, neighbouring ranges joined; own nodes only."""
    current: object = object()
    ranges: list[list[int]] = []
    for batch in batches:
        found = []
        for conv, k, node, position, start, size, own in _rows(batch):
            if conv != current:
                current, ranges = conv, []
            if ranges and ranges[-1][1] == start:
                ranges[-1] = [ranges[-1][0], start + size]
            else:
                ranges.append([start, start + size])
            if own:
                found.append([conv, k, node, position, start, [{"first": a, "last": b} for a, b in ranges]])
        yield _emit(found, _SPAN_KINDS)


def _by_conversation(frame: DataFrame, *order: str) -> DataFrame:
    return frame.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def build_tree(conversations: DataFrame) -> Tree:
    """Prefix tree of ``conversations(conv_id, turn, role, text)``.

    Turns are taken in the order of (turn, role, text), so ties and repeated rows have a place each.
    NULL text or role: empty. NULL conv_id: one more conversation. NULL turn: before all others. Other
    columns are ignored. Texts of one conversation are read in a stream; for the depth-first order the keys of its
    turns, 16 characters each, come together in one row.
    """
    source = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sorted_turns = _by_conversation(source, "turn", "role", "text").select("conv_id", "role", "text")
    turns = stage(sorted_turns.mapInArrow(_chain, TURNS), "chat-turns")
    size = F.length(_format(F.col("role"), F.col("text"))).cast("long")
    steps = turns.select("conv_id", "k", "node", "tree", "position", size.alias("size"))
    # depth-first order: by the path of nodes; one short key per turn
    paths = steps.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("k", F.substring("node", 1, 16).alias("key")))).alias("path")
    )
    paths = paths.select("conv_id", F.transform("path", lambda step: step["key"]).alias("path"))
    # ids grow with the order of the sorted partitions, and are stored before use
    order = stage(
        paths.orderBy("path", "conv_id").select("conv_id", F.monotonically_increasing_id().alias("rank")), "chat-order"
    )
    ranked = steps.join(order.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")))
    facts = [F.max(name).alias(name) for name in ("size", "position", "tree")]
    owners = ranked.groupBy("node").agg(F.min("rank").alias("owner"), *facts)
    lengths = owners.groupBy("owner").agg(
        F.sum("size").alias("length"), F.min("position").alias("head"), F.max("tree").alias("tree")
    )
    # running sum over all conversations: within a sorted partition, plus the partitions before
    lengths = lengths.withColumn("part", F.shiftright("owner", 33))
    totals = lengths.groupBy("part").agg(F.sum("length").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("part").alias("_part"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    earlier = Window.partitionBy("part").orderBy("owner").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        lengths.withColumn("inner", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
        .join(totals, F.col("part") == F.col("_part"))
        .select("owner", "head", "tree", (F.col("base") + F.col("inner")).alias("offset"))
    )
    offsets = stage(offsets, "chat-offsets")
    roots = offsets.groupBy("tree").agg(F.min("offset").alias("root"))
    placed = (
        owners.drop("tree")
        .join(offsets.join(roots, "tree"), "owner")
        .select(
            F.col("node").alias("_node"),
            "owner",
            (F.col("offset") - F.col("root") + F.col("position") - F.col("head")).alias("start"),
        )
    )
    walked = ranked.join(placed, F.col("node") == F.col("_node")).select(
        "conv_id", "k", "node", "position", "start", "size", (F.col("rank") == F.col("owner")).alias("own")
    )
    spans = _by_conversation(walked, "k").mapInArrow(_attend, SPANS)
    facts = turns.select(F.col("conv_id").alias("_conv"), F.col("k").alias("_k"), "parent", "tree", "role", "text")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("k") == F.col("_k"))
    formatted = _format(F.col("role"), F.col("text"))
    first = F.length(F.concat(F.lit(TURN), _escape(F.col("role")), F.lit(TEXT)))
    learned = F.struct(first.alias("first"), (F.length(formatted) - len(END)).alias("last"))
    nodes = spans.join(facts, same).select(
        "node",
        "parent",
        "tree",
        "role",
        "start",
        "position",
        formatted.alias("formatted"),
        F.when(F.col("role") == LEARNED, learned).alias("learned"),
        "attend",
    )
    return Tree(nodes, turns.select("conv_id", "k", "node"))


def _escape(text: Column) -> Column:
    for sign, spelled in ESCAPES:
        text = F.replace(text, F.lit(sign), F.lit(spelled))
    return text


def _format(role: Column, text: Column) -> Column:
    return F.concat(F.lit(TURN), _escape(role), F.lit(TEXT), _escape(text), F.lit(END))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation from its formatted nodes, in a stream."""
    current: object = object()
    state: list | None = None

    def closed(one: list) -> list:
        conv, turns, all_turns, chars, loss, size = one
        return [conv, turns, all_turns.hexdigest(), chars, loss.hexdigest(), size]

    for batch in batches:
        found = []
        for conv, formatted, first, last in _rows(batch):
            if conv != current:
                if state is not None:
                    found.append(closed(state))
                current, state = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse_turn(formatted)
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            if first is not None:
                said = unescape(formatted[first:last])
                state[3] += len(said)
                state[4].update(said.encode())
            state[5] += len(formatted)
        yield _emit(found, _BACK_KINDS)
    if state is not None:
        yield _emit([closed(state)], _BACK_KINDS)


def read_conversations(tree: Tree) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` read back from a tree.

    Each conversation is put together again from the nodes of its path; digests are those of role, line
    feed, text, line feed per turn, and of the unescaped text under the loss mask.
    """
    nodes = tree.nodes.select(
        F.col("node").alias("_node"), "formatted", F.col("learned.first").alias("first"), F.col("learned.last").alias("last")
    )
    joined = tree.paths.join(nodes, F.col("node") == F.col("_node")).select("conv_id", "k", "formatted", "first", "last")
    return _by_conversation(joined, "k").select("conv_id", "formatted", "first", "last").mapInArrow(_read, BACK)
