"""Stored trigram postings over names, e-mails and phones: containment searches read only what they need.

Three tables under one version: ``postings`` (field, trigram, id) sorted so that a trigram is a few row groups,
``counts`` of each trigram, and ``rows``, the golden records in folders by the first digits of their id.
"""

from __future__ import annotations

import json
import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenrec.operators import search
from goldenrec.operators.paging import page_of
from goldenrec.plans import versions
from goldenrec.session import stage

# The parameter of a search and the golden column it looks into.
FIELDS = {"q": "nome_razao_social", "email": "emails", "telefone": "telefones"}
POSTINGS, COUNTS, ROWS = "postings", "counts", "rows"
# Rarest trigrams of a text whose postings are intersected; candidates are verified on the text itself.
PROBES = 4
# Golden rows wanted in a folder.
FOLDER_ROWS = 1_000_000
# Texts of a record whose trigrams are made distinct in its row.
LIST_TEXTS = 64
# What stands before the bytes of an id that is no md5.
OTHER_ID = bytes(16) + b"\x01"
# Folder of the record without an id.
NO_ID = "-"


def _trigrams(text: Column) -> Column:
    """All runs of three characters of a text, lower-cased as the search compares them; none for shorter ones."""
    lower = F.lower(text)
    starts = F.sequence(F.lit(1), F.length(lower) - 2)
    return F.when(F.length(lower) >= 3, F.transform(starts, lambda i: F.substr(lower, i, F.lit(3))))


def _grams(golden: DataFrame) -> DataFrame:
    """``campo, trigrama, id_golden``: the distinct trigrams of each record's searchable texts.

    Those of a record are made distinct in its row, without a shuffle; long lists are rows before they become trigrams.
    """
    parts = []
    for field, column in FIELDS.items():
        name, own = F.lit(field).alias("campo"), F.col(column)
        if field == "q":
            parts.append(golden.select(name, F.explode(F.array_distinct(_trigrams(own))).alias("trigrama"), "id_golden"))
            continue
        short = golden.where(F.size(own) <= LIST_TEXTS)
        grams = F.array_distinct(F.flatten(F.filter(F.transform(own, _trigrams), F.isnotnull)))
        parts.append(short.select(name, F.explode(grams).alias("trigrama"), "id_golden"))
        texts = golden.where(F.size(own) > LIST_TEXTS).select(F.explode(own).alias("texto"), "id_golden")
        long = texts.select(name, F.explode(_trigrams(F.col("texto"))).alias("trigrama"), "id_golden")
        parts.append(long.distinct())
    return reduce(DataFrame.unionAll, parts)


def _packed(name: Column) -> Column:
    """An id as bytes: the 16 that 32 hex digits stand for, any other text behind 16 zeros and a one."""
    return F.when(name.rlike(r"\A[0-9a-f]{32}\z"), F.unhex(name)).otherwise(F.concat(F.lit(OTHER_ID), F.encode(name, "UTF-8")))


def _unpacked(packed: Column) -> Column:
    rest = F.decode(F.substring(packed, len(OTHER_ID) + 1, 2**31 - 1), "UTF-8")
    return F.when(F.length(packed) == len(OTHER_ID) - 1, F.lower(F.hex(packed))).otherwise(rest)


def _folder(digits: int) -> Column:
    return F.coalesce(F.left("id_golden", F.lit(digits)), F.lit(NO_ID))


def build_index(golden: DataFrame, root: str) -> None:
    """Store the postings of a golden table below ``root``, in place of those before."""
    spark, root = golden.sparkSession, root.rstrip("/")
    before = versions.current(spark, root)
    names = {role: versions.new_folder(before) for role in (POSTINGS, COUNTS, ROWS)}
    # ids as bytes: half of what the postings hold
    grams = _grams(golden).withColumn("id_golden", _packed(F.col("id_golden")))
    # ranges split a trigram that a third of all names have; the order lets readers skip row groups
    order = ["campo", "trigrama", "id_golden"]
    grams.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{root}/{names[POSTINGS]}")
    stored = spark.read.schema(grams.schema).parquet(f"{root}/{names[POSTINGS]}")
    counts = stored.groupBy("campo", "trigrama").agg(F.count(F.lit(1)).alias("n"))
    counts.sortWithinPartitions("campo", "trigrama").write.parquet(f"{root}/{names[COUNTS]}")
    digits = max(1, math.ceil(math.log(max(golden.count() / FOLDER_ROWS, 1), 16)))
    rows = golden.withColumn("pasta", _folder(digits))
    rows.repartition("pasta").sortWithinPartitions("id_golden").write.partitionBy("pasta").parquet(f"{root}/{names[ROWS]}")
    folders = {role: [name] for role, name in names.items()}
    versions.commit(spark, root, folders, {"digits": digits, "schema": golden.schema.json()}, after=before.number if before else 0)
    versions.clean(spark, root)


def _wanted(spark: SparkSession, field: str, text: str) -> list[str]:
    """Trigrams that every match has. Wildcards part a text; phones are searched by their digits."""
    if field == "telefone":
        pieces = [search.only_digits(text) or ""]
    else:
        pieces = re.split("[%_]", text.lower() if field == "email" else text)
    frame = spark.createDataFrame([(piece,) for piece in pieces], "texto string")
    found = frame.select(F.explode(_trigrams(F.col("texto"))).alias("trigrama")).distinct()
    # as many as the search text is long
    return [row.trigrama for row in found.collect()]


class Index:
    """The stored postings as of one version."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.version = versions.current(spark, root)
        if self.version is None:
            raise FileNotFoundError(f"no postings in {root}")

    def _path(self, role: str) -> str:
        return f"{self.root}/{self.version.folders[role][0]}"

    def ids(self, field: str, text: str) -> DataFrame | None:
        """Ids whose texts hold the rarest trigrams of ``text``; None if it has no trigram."""
        wanted = _wanted(self.spark, field, text)
        if not wanted:
            return None
        own = (F.col("campo") == field) & F.col("trigrama").isin(wanted)
        counts = self.spark.read.schema("campo string, trigrama string, n long").parquet(self._path(COUNTS)).where(own)
        known = {row.trigrama: row.n for row in counts.collect()}
        rarest = sorted(wanted, key=lambda gram: (known.get(gram, 0), gram))[:PROBES]
        postings = self.spark.read.schema("campo string, trigrama string, id_golden binary").parquet(self._path(POSTINGS))
        hits = postings.where((F.col("campo") == field) & F.col("trigrama").isin(rarest))
        # a record has a trigram once, so the count says whether it has all
        found = hits.groupBy("id_golden").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(rarest))
        return found.select(_unpacked(F.col("id_golden")).alias("id_golden"))

    def rows(self, ids: DataFrame | None) -> DataFrame:
        """Golden records with these ids (all, without), read from the folders that have some."""
        schema = T.StructType.fromJson(json.loads(self.version.notes["schema"]))
        names = schema.fieldNames()
        # told and not inferred: digits alone would be read as numbers
        golden = self.spark.read.schema(schema.add("pasta", T.StringType())).parquet(self._path(ROWS))
        if ids is None:
            return golden.select(names)
        found = stage(ids, "candidates")
        folder = _folder(self.version.notes["digits"])
        # at most 16 to the power of the digits, by how many rows there are to a folder
        folders = [row[0] for row in found.select(folder).distinct().collect()]
        own = golden.where(F.col("pasta").isin(folders))
        wanted = found.withColumnRenamed("id_golden", "_id")
        return own.join(wanted, F.col("id_golden").eqNullSafe(F.col("_id")), "left_semi").select(names)

    def matches(self, **filters: str | None) -> DataFrame:
        """Golden rows that pass every filter that is set, as ``search_matches`` defines them.

        Texts of three and more characters between wildcards choose the candidates by postings; without one
        all rows are read.
        """
        found = None
        for field in FIELDS:
            ids = self.ids(field, filters[field]) if filters.get(field) else None
            if ids is not None:
                both = None if found is None else F.col("id_golden").eqNullSafe(F.col("_other"))
                found = ids if found is None else found.join(ids.withColumnRenamed("id_golden", "_other"), both, "left_semi")
        return search.search_matches(self.rows(found), **filters)

    def search(self, *, page: int = 1, per_page: int = search.DEFAULT_PER_PAGE, **filters: str | None) -> search.Page:
        """One page of matching summaries: the same result as ``search.search`` on the golden table."""
        search.check_page(page, per_page, filters.get("uf") or None)
        # read once for the total and the page
        matches = stage(self.matches(**filters), "matches")
        total = matches.count()
        rows = page_of(matches, page, per_page, "id_golden", search.RANKING)
        return search.Page(total, page, per_page, page * per_page < total, search.present(rows, search.SUMMARY))
