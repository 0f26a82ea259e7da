"""CSV with line breaks in fields, read in byte ranges, against Python's csv module."""

import csv
import random

import pytest

from goldenrec.sources.readers import csv_records, read_csv_text
from helpers import FAILED_QUERY

COLUMNS = ("a", "b", "c")


def write(path, rows, ending="\n", **options):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=ending, **options)
        writer.writerows([COLUMNS, *rows])


def made(seed, count):
    rng = random.Random(seed)
    texts = ["x", "", " s ", 'q"q', '"', '""', "a,b", "line\nbreak", "\n", "\n\n", 'end"\n', '\n"', "é日", "\r\nz", "12"]
    return [[rng.choice(texts) for _ in COLUMNS[:-1]] + [str(i)] for i in range(count)]


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    spark.conf.set(names[0], "700b")
    spark.conf.set(names[1], "0")
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def as_rows(frame):
    return sorted([list(r) for r in frame.collect()], key=lambda r: int(r[2] or -1))


@pytest.mark.parametrize(("ending", "quoting"), [("\n", csv.QUOTE_MINIMAL), ("\r\n", csv.QUOTE_ALL), ("\n", csv.QUOTE_ALL)])
def test_one_file_by_several_tasks(spark, tmp_path, small_ranges, ending, quoting):
    rows = made(7, 600)
    if ending == "\r\n":
        rows = [[value.replace("\r\n", "\n") for value in row] for row in rows]
    write(tmp_path / "one.csv", rows, ending, quoting=quoting)
    frame = read_csv_text(spark, str(tmp_path / "one.csv"), COLUMNS)
    assert spark.read.text(str(tmp_path / "one.csv")).rdd.getNumPartitions() > 5
    assert as_rows(frame) == rows


def test_several_files_and_long_records(spark, tmp_path, small_ranges):
    rows = made(3, 300)
    rows[10][0] = "l\n" * 2000
    for part in range(3):
        write(tmp_path / f"{part}.csv", rows[part * 100 : part * 100 + 100])
    assert as_rows(read_csv_text(spark, str(tmp_path), COLUMNS)) == rows


def test_no_line_breaks_no_shuffle_of_lines(spark, tmp_path, small_ranges):
    rows = [[f'v"{i}', "", str(i)] for i in range(200)]
    write(tmp_path / "plain.csv", rows)
    frame = read_csv_text(spark, str(tmp_path / "plain.csv"), COLUMNS)
    assert as_rows(frame) == rows
    assert "Window" not in frame._jdf.queryExecution().executedPlan().toString()
    assert as_rows(read_csv_text(spark, str(tmp_path / "plain.csv"), COLUMNS, line_breaks=False)) == rows


def test_wrong_lines_and_an_open_quote(spark, tmp_path, small_ranges):
    good = "".join(f'"x\n{i}",b,{i}\n' for i in range(40))
    (tmp_path / "bad.csv").write_text(f'a,b,c\n{good}only,two\n\n"a\nb",c,99,d\nk,"never closed,1\nl,m,2\n', encoding="utf-8")
    frame = read_csv_text(spark, str(tmp_path / "bad.csv"), COLUMNS, corrupt=True)
    wrong = sorted(r._corrupt for r in frame.where("_corrupt is not null").collect())
    assert wrong == ['"a\nb",c,99,d', 'k,"never closed,1', "l,m,2", "only,two"]
    assert frame.where("_corrupt is null").count() == 40
    with pytest.raises(FAILED_QUERY):
        read_csv_text(spark, str(tmp_path / "bad.csv"), COLUMNS).collect()


def test_empty_files(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "head.csv").write_text("a,b,c\n")
    assert csv_records(spark, str(tmp_path)).count() == 0
