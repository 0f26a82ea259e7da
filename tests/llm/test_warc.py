"""Archive round trip."""

import hashlib
from collections import Counter

import pytest

from goldenrec.llm.warc import read_archive, write_archive
from helpers import FAILED_QUERY

LONG = "<p>" + "é" * 60 + "</p>"
ROWS = [
    (5, "http://a/", LONG),
    (3, "http://b/\r\nX: 1", LONG),
    (9, None, LONG),
    (4, "http://c/", "short"),
    (6, "http://d/", "short"),
    (7, "http://e/", None),
    (None, "http://f/", LONG),
    (None, "http://g/", "only without id " * 10),
    (10, "http://h/", "x" * 100),
    (11, "http://h/", "x" * 100),
    (12, "http://i/", "x" * 99),
    (13, "http://i/", "x" * 99),
    (13, "http://i/", "x" * 99),
    (20, "http://j/", "WARC/1.1\r\nWARC-Type: revisit\r\n\r\n" * 2000),
    (21, "http://j/", "WARC/1.1\r\nWARC-Type: revisit\r\n\r\n" * 2000),
    (30, "", "no address"),
    (31, "http://k/%0A%25\n%0D", "line break and codes"),
    (32, "http://k/%0A%25%0D", "codes alone"),
]


@pytest.fixture()
def archive(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, header string")
    write_archive(pages.repartition(3), str(tmp_path / "w"))
    return str(tmp_path / "w")


def test_round_trip(spark, archive):
    found = read_archive(spark, archive).collect()
    firsts = {}
    for page, _, html in ROWS:
        if page is not None:
            firsts[html or ""] = min(firsts.get(html or "", page), page)
    expected = Counter()
    for page, url, html in ROWS:
        data, first = (html or "").encode(), firsts.get(html or "")
        revisit = len(data) >= 100 and page != first
        expected[page, url, data, "revisit" if revisit else "response", first if revisit else None] += 1
    assert Counter((r.page_id, r.url, bytes(r.payload), r.record_type, r.refers_to) for r in found) == expected
    for r in found:
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        assert head + b"\r\n\r\n" == bytes(r.header) and block.endswith(b"\r\n\r\n")
        body = block[:-4]
        assert body == (b"" if r.record_type == "revisit" else bytes(r.payload))
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert int(fields["Content-Length"]) == len(body)
        assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(bytes(r.payload)).hexdigest()


def test_payloads_are_stored_once(spark, archive):
    stored = spark.read.parquet(f"{archive}/payloads")
    assert stored.count() == stored.select("digest").distinct().count() == len({html or "" for _, _, html in ROWS})
    assert spark.read.parquet(f"{archive}/headers").count() == len(ROWS)


def test_damage_is_found(spark, archive, tmp_path):
    stored = spark.read.parquet(f"{archive}/payloads").replace("nothing", "")
    broken = str(tmp_path / "broken")
    stored.selectExpr("digest", "concat(payload, cast('!' as binary)) as payload").write.parquet(f"{broken}/payloads")
    spark.read.parquet(f"{archive}/headers").write.parquet(f"{broken}/headers")
    with pytest.raises(FAILED_QUERY, match="does not fit its digest"):
        read_archive(spark, broken).collect()
    lost = str(tmp_path / "lost")
    stored.limit(0).write.parquet(f"{lost}/payloads")
    spark.read.parquet(f"{archive}/headers").write.parquet(f"{lost}/headers")
    with pytest.raises(FAILED_QUERY, match="no payload with digest"):
        read_archive(spark, lost).collect()


def test_empty(spark, tmp_path):
    write_archive(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "e"))
    assert read_archive(spark, str(tmp_path / "e")).count() == 0
