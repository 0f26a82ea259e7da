"""Secret scans over a trigram index, in DataFrame functions alone.

Each rule's regular expression gives a Boolean query over the trigrams that every match must contain.
Postings (trigram, document) of the trigrams that any rule asks for are intersected per query; only the
documents left are verified with the expression itself. Rules without mandatory trigrams (a run of hex
digits, say) are run over every text.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """``group`` of a match of ``pattern`` must have ``least`` characters, or the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base rules, in the order in which spans with one start are listed.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
# Rules that the scan adds.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repository_token", r"gh[opsu]_[A-Za-z0-9]{30,}"),
    Rule("chat_token", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

# A query is a tuple of clauses, one of which must hold; a clause is a set of trigrams, all needed.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])
# Strings kept while following an expression; past that they are turned into trigrams.
MOST_STRINGS = 64


def _simplest(query: Query) -> Query:
    return frozenset(c for c in query if not any(other < c for other in query))


def _and(left: Query, right: Query) -> Query:
    return _simplest(frozenset(a | b for a in left for b in right))


def _or(queries: list[Query]) -> Query:
    return _simplest(frozenset().union(*queries))


def _strings_query(strings: frozenset[str]) -> Query:
    """One of the strings occurs: all its trigrams do. Strings under three characters say nothing."""
    return _or([frozenset([frozenset(s[i : i + 3] for i in range(len(s) - 2))]) for s in strings])


def _set_members(items: list) -> frozenset[str] | None:
    """Characters of a small set, lower-cased."""
    found: set[str] = set()
    for kind, value in items:
        if str(kind) == "LITERAL":
            found.add(chr(value).lower())
        elif str(kind) == "RANGE" and value[1] - value[0] < 8:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return frozenset(found) if len(found) <= 8 else None


def _strings(kind: str, value) -> frozenset[str] | None:
    """All lower-cased strings a part of the expression can match, if they are few."""
    if kind == "LITERAL":
        return frozenset([chr(value).lower()])
    if kind == "IN":
        return _set_members(value)
    if kind == "SUBPATTERN":
        return _sequence_strings(value[-1])
    if kind == "BRANCH":
        parts = [_sequence_strings(part) for part in value[1]]
        return None if None in parts else frozenset().union(*parts)
    if kind == "MAX_REPEAT" and value[1] == 1:
        own = _sequence_strings(value[2])
        return own if own is None or value[0] else own | {""}
    return None


def _sequence_strings(parts) -> frozenset[str] | None:
    found = frozenset([""])
    for kind, value in parts:
        own = _strings(str(kind), value)
        if own is None or len(found) * len(own) > MOST_STRINGS:
            return None
        found = frozenset(a + b for a in found for b in own)
    return found


def _query(parts) -> Query:
    query, strings = ANY, frozenset([""])
    for kind, value in parts:
        own = _strings(str(kind), value)
        if own is not None and len(strings) * len(own) <= MOST_STRINGS:
            strings = frozenset(a + b for a in strings for b in own)
            continue
        query, strings = _and(query, _strings_query(strings)), frozenset([""])
        if own is not None:
            strings = own
        elif str(kind) == "SUBPATTERN":
            query = _and(query, _query(value[-1]))
        elif str(kind) == "BRANCH":
            query = _and(query, _or([_query(part) for part in value[1]]))
        elif str(kind) == "MAX_REPEAT" and value[0] > 0:
            query = _and(query, _query(value[2]))
    return _and(query, _strings_query(strings))


def trigram_query(pattern: str) -> Query:
    """Trigrams of the lower-cased text that any match needs; ``ANY`` if there are none."""
    return _query(re._parser.parse(pattern))


def candidates(docs: DataFrame, queries: dict[int, Query]) -> DataFrame:
    """``doc_id, version, rules``: bit per rule whose query holds, for documents with any.

    ``docs(doc_id, version, text)``; the postings of a document are the asked trigrams it holds.
    """
    spark: SparkSession = docs.sparkSession
    asked = sorted({t for query in queries.values() for clause in query for t in clause})
    lower = F.lower("text")
    present = F.array_compact(F.array(*[F.when(F.contains(lower, F.lit(t)), F.lit(t)) for t in asked]))
    postings = docs.select("doc_id", "version", F.explode(present).alias("trigram"))
    rows = []
    number = 0
    for rule, query in queries.items():
        for clause in sorted(query, key=sorted):
            for bit, trigram in enumerate(sorted(clause)):
                rows.append((trigram, number, 1 << rule, 1 << bit, (1 << len(clause)) - 1))
            number += 1
    # as many rows as the rules have trigrams
    clauses = F.broadcast(spark.createDataFrame(rows, "trigram string, clause int, rule long, bit long, all long"))
    held = postings.join(clauses, "trigram").groupBy("doc_id", "version", "clause", "rule", "all").agg(
        F.bit_or("bit").alias("bits")
    )
    return held.where("bits = all").groupBy("doc_id", "version").agg(F.bit_or("rule").alias("rules"))


SPAN = "array<struct<start:long,rank:int,kind:string,end:long>>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule: leftmost matches that do not overlap, in code points, end exclusive.

    The pieces between matches and the matches themselves add up to the places.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    groups = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"), matches.alias("match"), groups.alias("own")
    )
    empty = F.array().cast(SPAN)
    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("found"))

    def add(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["gap"])
        end = begin + F.coalesce(F.length(part["match"]), F.lit(0))
        span = F.struct(
            begin.cast("long").alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(rule.kind).alias("kind"),
            end.cast("long").alias("end"),
        )
        wanted = F.coalesce(F.length(part["own"]) >= rule.least, F.lit(False))
        return F.struct(
            end.cast("long").alias("at"),
            F.when(wanted, F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"),
        )

    # one pass without positions decides for most texts
    return F.when(text.rlike(_tight(rule)), F.aggregate(parts, start, add, lambda state: state["found"])).otherwise(empty)


def _tight(rule: Rule) -> str:
    """Expression that a text with a valid match must match: the length bound at the closing run."""
    if rule.group == 0 and rule.pattern.endswith("]+") and rule.least > 1:
        head = rule.pattern[: rule.pattern.rindex("[")]
        return f"{rule.pattern[:-1]}{{{rule.least - len(head)},}}"
    return rule.pattern


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``doc_id, spans`` for every row of ``docs(doc_id, text)``: start, rank, kind and end of each secret.

    Spans are sorted by start, then by the order of the rules; different rules may overlap.

    NULL text: no spans. NULL doc_id: an id like any other. Rows repeating doc_id and text get a row
    each with the same spans. Other columns are ignored.
    """
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    source = source.withColumn("version", F.xxhash64("text"))
    queries = {rank: trigram_query(rule.pattern) for rank, rule in enumerate(rules)}
    indexed = {rank: query for rank, query in queries.items() if query != ANY}
    text, mask = F.col("text"), F.lit(0).cast("long")
    if indexed:
        found = candidates(source, indexed).withColumnsRenamed({"doc_id": "_id", "version": "_version"})
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version"))
        source = source.join(found, same, "left")
        mask = F.coalesce("rules", F.lit(0).cast("long"))
    each = []
    for rank, rule in enumerate(rules):
        spans = _spans(text, rule, rank)
        if rank in indexed:
            spans = F.when(mask.bitwiseAND(F.lit(1 << rank)) != 0, spans).otherwise(F.array().cast(SPAN))
        each.append(spans)
    return source.select("doc_id", F.array_sort(reduce(F.concat, each)).alias("spans"))


def spelled(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
