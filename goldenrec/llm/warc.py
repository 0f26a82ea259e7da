"""Content-addressed web archive: payloads once by digest, exact record headers beside them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenrec.operators.joins import shuffled_alone

# Payloads from this size on are written once and revisited; smaller records are all responses.
REVISIT_BYTES = 100
CRAWL_DATE = "2024-01-01T00:00:00Z"
# Fixed value: profile of a revisit by equal payload.
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
BREAK = "\r\n"


class Archive(NamedTuple):
    """``headers(page_id, header)`` in their exact bytes, ``payloads(digest, payload)``."""

    headers: DataFrame
    payloads: DataFrame


def _record_id(page_id: Column, digest: Column) -> Column:
    """Identifier that every run gives the same record."""
    name = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("-")), digest).cast("binary"))
    parts = [F.substring(name, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))


def _optional(name: str, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).otherwise(_line(name, value))


def _escaped(url: Column) -> Column:
    for sign, code in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        url = F.replace(url, F.lit(sign), F.lit(code))
    return url


def _unescaped(url: Column) -> Column:
    for sign, code in (("\n", "%0A"), ("\r", "%0D"), ("%", "%25")):
        url = F.replace(url, F.lit(code), F.lit(sign))
    return url


def make_archive(pages: DataFrame, date: str = CRAWL_DATE) -> Archive:
    """The two tables of the archive of ``pages(page_id, url, html)``, one record per row.

    Of rows with equal payloads of at least 100 bytes, those with the smallest page_id are responses and
    the others revisit it. NULL html: empty payload. NULL url: no target line, an empty one: an empty line; line
    breaks in a url are percent-encoded, and a second line has such a url in a form that gives it back. NULL page_id: no id line, a revisit if an equal payload has an id, else a response.
    Rows repeating page_id and html are records each, of one kind. Other columns are ignored.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    source = source.withColumn("digest", F.sha2("payload", 256))
    payloads = source.select("digest", "payload").dropDuplicates(["digest"])
    facts = source.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes"))
    firsts = facts.groupBy("digest").agg(F.min("page_id").alias("first"))
    facts = facts.join(shuffled_alone(firsts, "digest"), "digest")
    page_id, first, digest = F.col("page_id"), F.col("first"), F.col("digest")
    revisit = (F.col("bytes") >= REVISIT_BYTES) & ~page_id.eqNullSafe(first)
    kind = F.when(revisit, "revisit").otherwise("response")
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    broken = F.col("url").rlike(r"[\r\n]")
    header = F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _record_id(page_id, digest)),
        _line("WARC-Date", F.lit(date)),
        _optional("WARC-Target-URI", url),
        _optional("WARC-Target-URI-Escaped", F.when(broken, _escaped(F.col("url")))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        _optional("WARC-Page-ID", page_id.cast("string")),
        _optional("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _optional("WARC-Refers-To", F.when(revisit, _record_id(first, digest))),
        _optional("WARC-Refers-To-Page-ID", F.when(revisit, first.cast("string"))),
        F.lit(f"Content-Type: text/html; charset=utf-8{BREAK}"),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(BREAK),
    )
    return Archive(facts.select("digest", header.cast("binary").alias("header")), payloads)


def write_archive(pages: DataFrame, path: str, date: str = CRAWL_DATE) -> None:
    """Writes ``path/headers`` and ``path/payloads``; a payload is stored once however many records have it."""
    archive = make_archive(pages, date)
    archive.payloads.write.parquet(f"{path}/payloads")
    archive.headers.write.parquet(f"{path}/headers")


def _field(header: Column, name: str) -> Column:
    value = F.regexp_extract(header, rf"(?:^|\r\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """All records: ``page_id, url, record_type, refers_to, header, payload, record``.

    ``payload`` is the full one, of revisits too; ``record`` the exact bytes of the record in a WARC
    file: header, block (none for revisits) and two line breaks. A payload that is missing, or that
    its digest does not fit, is an error.
    """
    stored = spark.read.parquet(f"{path}/payloads").withColumnRenamed("digest", "_digest")
    fits = F.sha2("payload", 256) == F.col("_digest")
    wrong = F.raise_error(F.concat(F.lit("payload does not fit its digest "), F.col("_digest")))
    stored = stored.withColumn("payload", F.when(fits, F.col("payload")).otherwise(wrong.cast("binary")))
    headers = spark.read.parquet(f"{path}/headers")
    text = F.col("header").cast("string")
    told = F.replace(_field(text, "WARC-Payload-Digest"), F.lit("sha256:"), F.lit(""))
    joined = headers.withColumn("_told", told).join(stored, F.col("_told") == F.col("_digest"), "left")
    lost = F.raise_error(F.concat(F.lit("no payload with digest "), F.col("_told")))
    payload = F.coalesce("payload", lost.cast("binary"))
    kind = _field(text, "WARC-Type")
    empty = F.when(F.contains(text, F.lit(f"{BREAK}WARC-Target-URI: {BREAK}")), F.lit(""))
    url = F.coalesce(_unescaped(_field(text, "WARC-Target-URI-Escaped")), _field(text, "WARC-Target-URI"), empty)
    block = F.when(kind == "revisit", F.lit(b"")).otherwise(payload)
    return joined.select(
        _field(text, "WARC-Page-ID").cast("long").alias("page_id"),
        url.alias("url"),
        kind.alias("record_type"),
        _field(text, "WARC-Refers-To-Page-ID").cast("long").alias("refers_to"),
        "header",
        payload.alias("payload"),
        F.concat("header", block, F.lit(b"\r\n\r\n")).alias("record"),
    )
