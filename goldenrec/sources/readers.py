"""Readers of the five source shapes and of the stored layers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenrec import schemas
from goldenrec.session import stage


def jdbc_options(
    url: str,
    table: str,
    key: str,
    bounds: tuple[int, int],
    partitions: int,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a full-table read split into ``partitions`` ranges of the integer ``key``."""
    low, high = bounds
    return {
        **(properties or {}),
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(max(high, low + 1)),
        "numPartitions": str(partitions),
    }


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    *,
    partitions: int = 64,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Whole relational table over JDBC, read in parallel key ranges.

    The key bounds come from one aggregate the database answers itself; rows outside them cannot
    be lost because Spark leaves the first and last range open.
    """
    probe = f"(select min({key}) as low, max({key}) as high from {table}) as bounds"
    reader = spark.read.format("jdbc").options(url=url, dbtable=probe, **(properties or {}))
    low, high = reader.load().first()
    if low is None:
        return (
            spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {})).load()
        )
    options = jdbc_options(url, table, key, (int(low), int(high)), partitions, properties)
    return spark.read.format("jdbc").options(**options).load()


# Column that carries the text of a record that could not be read; NULL for all others.
CORRUPT = "_corrupt"


def _sound(frame: DataFrame, corrupt: bool) -> DataFrame:
    """Keeps the corrupt column for the quarantine, or fails at the first record that has one."""
    if corrupt:
        return frame
    wrong = F.raise_error(F.concat(F.lit("unreadable record: "), F.left(CORRUPT, F.lit(200))))
    checked = F.when(F.col(CORRUPT).isNotNull(), wrong.cast("boolean")).otherwise(F.lit(True))
    return frame.where(checked).drop(CORRUPT)


def read_documents(spark: SparkSession, path: str, corrupt: bool = False) -> DataFrame:
    """Newline-delimited documents of any shape, one VARIANT column ``doc``; blank lines are skipped.

    A line that is no JSON object fails the read; with ``corrupt`` it becomes a row without document
    and with its text in ``_corrupt``.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.try_parse_json("value").alias("doc"))
    whole = F.coalesce(F.startswith(F.schema_of_variant("doc"), F.lit("OBJECT")), F.lit(False))
    return _sound(
        parsed.select(F.when(whole, F.col("doc")).alias("doc"), F.when(~whole, F.col("value")).alias(CORRUPT)), corrupt
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``value, closed``: the records of CSV files without their headers, also those that go on over line breaks.

    Spark cuts the files into byte ranges and these into lines. A line with an odd number of quotes opens or closes
    a field that holds line breaks, so the number of such lines before a line says whether it lies inside a record and
    which: counts per byte range, their running sum, and a running sum inside each range. Only lines of longer records
    are shuffled a second time. A quote that no line closes leaves its lines apart, with ``closed`` false.

    Quotes inside fields are doubled, as RFC 4180 has it.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    at = F.col("_metadata")
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            "value",
            at["file_path"].alias("file"),
            at["file_block_start"].alias("block"),
            (quotes % 2).alias("odd"),
            # grows along a byte range; ranges of one file may lie in any order
            F.monotonically_increasing_id().alias("line"),
        )
    )
    ranges = lines.groupBy("file", "block").agg(F.sum("odd").alias("odds"), F.min("line").alias("first"))
    # one row per byte range
    along = Window.partitionBy("file").orderBy("block")
    ranges = ranges.withColumns(
        {
            "before": F.sum("odds").over(along) - F.col("odds"),
            "total": F.sum("odds").over(Window.partitionBy("file")),
        }
    )
    ranges = stage(ranges.drop("odds"), "csv-ranges")
    placed = lines.join(ranges, ["file", "block"]).where((F.col("block") > 0) | (F.col("line") > F.col("first")))
    text = F.regexp_replace("value", r"\r\z", "").alias("value")
    if ranges.where("total > 0").isEmpty():
        return placed.where(~F.col("value").isin("", "\r")).select(text, F.lit(True).alias("closed"))
    inside = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    counted = placed.withColumn("seen", F.col("before") + F.coalesce(F.sum("odd").over(inside), F.lit(0)))
    alone = (F.col("odd") == 0) & (F.col("seen") % 2 == 0)
    record = F.floor(F.col("seen") / 2)
    lost = ~alone & (F.col("total") % 2 == 1) & (record == F.floor(F.col("total") / 2))
    counted = counted.select("value", "file", "block", "line", record.alias("record"), alone.alias("alone"), lost.alias("lost"))
    whole = counted.where(F.col("alone") | F.col("lost"))
    whole = whole.where(~F.col("value").isin("", "\r")).select(text, (~F.col("lost")).alias("closed"))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    longer = counted.where(~F.col("alone") & ~F.col("lost")).groupBy("file", "record").agg(parts.alias("parts"))
    longer = longer.select(F.array_join(F.transform("parts", lambda part: part["value"]), "\n").alias("value"))
    return whole.unionAll(longer.select(text, F.lit(True).alias("closed")))


def read_csv_text(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...] = schemas.CSV_COLUMNS,
    line_breaks: bool = True,
    corrupt: bool = False,
) -> DataFrame:
    """CSV with a header, every field as the text it was; empty fields are '' and not NULL.

    A line with more or fewer fields than columns fails the read; with ``corrupt`` its text is in ``_corrupt``.

    Fields may hold line breaks, and still a file is read by as many tasks as its size asks for (``csv_records``);
    set ``line_breaks`` to false for files known to have none, which saves the pass that counts quotes.
    """
    layout = T.StructType([T.StructField(name, T.StringType()) for name in (*columns, CORRUPT)])
    options = {
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "columnNameOfCorruptRecord": CORRUPT,
    }
    if line_breaks:
        row = F.from_csv("value", layout.toDDL(), {**options, "multiLine": "true"}).alias("row")
        parsed = csv_records(spark, path).select("value", "closed", row)
        known = [F.when(F.col("closed"), F.col("row")[name]).alias(name) for name in columns]
        wrong = F.when(~F.col("closed"), F.col("value")).otherwise(F.col("row")[CORRUPT])
        frame = parsed.select(*known, wrong.alias(CORRUPT))
    else:
        frame = spark.read.schema(layout).options(header=True, **options).csv(path)
    fields = [F.coalesce(F.col(name), F.lit("")) for name in columns]
    # Spark refuses to read the corrupt text alone, so it is tied to a field
    told = F.concat(F.col(CORRUPT), F.left(fields[0], F.lit(0)))
    named = [field.alias(name) for field, name in zip(fields, columns, strict=True)]
    return _sound(frame.select(*named, told.alias(CORRUPT)), corrupt)


def read_pages(
    spark: SparkSession, path: str, file_per_page: bool = True, corrupt: bool = False
) -> DataFrame:
    """Records of landed pages ``{page, per_page, total, has_next, data[]}``, as ``doc`` VARIANT.

    Pages are files of their own, or lines of larger files. Those behind the first one that says
    ``has_next = false`` are stale and not read. A page that cannot be read, or pages that hold fewer or
    more records than the envelope's ``total``, fail the read; with ``corrupt`` they become rows without
    document and with the page's text, or the two counts, in ``_corrupt``.
    """
    texts = spark.read.text(path, wholetext=file_per_page).where(F.trim("value") != "")
    parsed = texts.select("value", F.try_parse_json("value").alias("page"))
    kinds = {"page": "bigint", "total": "bigint", "has_next": "boolean", "data": "array<variant>"}
    fields = [F.try_variant_get("page", f"$.{name}", kind).alias(name) for name, kind in kinds.items()]
    unread = F.col("data").isNull()
    pages = parsed.select(*fields, "value").withColumn(CORRUPT, F.when(unread, F.col("value"))).drop("value")
    # the texts are read and parsed once; what follows reads the columns it needs of the stored pages
    seen = Observation()
    ended = F.min(F.when(~F.col("has_next"), F.col("page"))).alias("last")
    pages = stage(pages.withColumn("held", F.coalesce(F.size("data"), F.lit(0))).observe(seen, ended), "pages")
    last = seen.get["last"]
    kept = pages if last is None else pages.where((F.col("page") <= last) | F.col(CORRUPT).isNotNull())
    total, held = kept.agg(F.max("total"), F.sum("held")).first()
    sound = F.lit(None).cast("string").alias(CORRUPT)
    records = kept.where(F.col(CORRUPT).isNull()).select(F.explode("data").alias("doc"), sound)
    unread = kept.where(F.col(CORRUPT).isNotNull()).select(F.lit(None).cast("variant").alias("doc"), CORRUPT)
    if total is not None and total != held:
        told = F.lit(f"pages hold {held} of {total} records")
        unread = unread.unionAll(spark.range(1).select(F.lit(None).cast("variant"), told))
    return _sound(records.unionAll(unread), corrupt)


def flatten_documents(
    documents: DataFrame, layout: T.StructType | None = None, doc: str = "doc"
) -> DataFrame:
    """Top-level keys of a VARIANT column as columns.

    Objects and arrays become JSON text, scalars keep the type ``layout`` gives (text by default).
    Keys outside ``layout`` become text columns; a key a document lacks is NULL. The column of corrupt
    records stays.
    """
    known = {field.name: field.dataType for field in layout} if layout else {}
    found = _document_keys(documents, doc)
    names = list(known) + [name for name in found if name not in known]
    kept = [F.col(CORRUPT)] if CORRUPT in documents.columns else []
    return documents.select(
        [_variant_field(doc, name, known.get(name)).alias(name) for name in names] + kept
    )


MAX_DOCUMENT_KEYS = 2000


def _document_keys(documents: DataFrame, doc: str) -> list[str]:
    """All top-level keys, sorted: the columns of the table to come."""
    entries = documents.sparkSession.tvf.variant_explode(F.col(doc).outer())
    keys = documents.lateralJoin(entries).select("key").distinct()
    found = sorted(row["key"] for row in keys.limit(MAX_DOCUMENT_KEYS + 1).collect())
    if len(found) > MAX_DOCUMENT_KEYS:
        raise ValueError(f"more than {MAX_DOCUMENT_KEYS} different keys: not a table")
    return found


def _variant_field(doc: str, name: str, kind: T.DataType | None) -> Column:
    """One key as text (objects and arrays as JSON), or as the scalar type asked for."""
    quote = '"' if "'" in name else "'"
    target = "string" if kind is None else kind.simpleString()
    return F.try_variant_get(F.col(doc), f"$[{quote}{name}{quote}]", target)


def iso_dates(frame: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO-8601 text; the fraction appears only when it is not zero."""

    def text(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
            seconds = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
            micros = F.date_format(column, "SSSSSS")
            fraction = F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros))
            return F.concat(seconds, fraction).alias(field.name)
        return column

    return frame.select([text(field) for field in frame.schema])


def read_bronze(
    spark: SparkSession,
    base: str,
    source: str,
    kind: str,
    since: tuple[int, int] | None = None,
    every_column: bool = False,
) -> DataFrame:
    """All batches of one source and registry type; ``since=(year, month)`` prunes older folders.

    The columns are those of the contract, without looking into any file. ``every_column`` adds
    what single batches have beyond them, at the price of reading all file footers. A source that never
    had a batch has no folder and no rows.
    """
    folder = f"{base}/{source}/{kind}"
    reader = spark.read.option("basePath", folder)
    try:
        if every_column:
            frame = reader.option("mergeSchema", True).parquet(folder)
        else:
            parts = [T.StructField(name, T.IntegerType()) for name in ("year", "month")]
            layout = T.StructType([*schemas.BRONZE[source, kind].fields, *parts])
            frame = reader.schema(layout).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_bronze(spark, source, kind)
    if since is not None:
        year, month = since
        frame = frame.where(
            (F.col("year") > year) | ((F.col("year") == year) & (F.col("month") >= month))
        )
    return frame.drop("year", "month")


def empty_bronze(spark: SparkSession, source: str, kind: str) -> DataFrame:
    """A source without batches, in the columns of its contract."""
    return spark.createDataFrame([], schemas.BRONZE[source, kind])


def read_batch(spark: SparkSession, base: str, source: str, kind: str, batch_id: str) -> DataFrame:
    """Rows of one stored batch, to verify it."""
    return read_bronze(spark, base, source, kind).where(F.col("_batch_id") == batch_id)


def bronze_all(frames: list[DataFrame]) -> DataFrame:
    """Union of differently shaped bronze tables by column name, absent columns NULL.

    Columns whose type differs between tables are read as text (names compare without case).
    """
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for field in frame.schema:
            kinds.setdefault(field.name.lower(), set()).add(field.dataType.simpleString())
    mixed = {name for name, found in kinds.items() if len(found) > 1}

    def aligned(frame: DataFrame) -> DataFrame:
        return frame.select(
            [
                F.col(name).cast("string").alias(name) if name.lower() in mixed else F.col(name)
                for name in frame.columns
            ]
        )

    union = aligned(frames[0])
    for frame in frames[1:]:
        union = union.unionByName(aligned(frame), allowMissingColumns=True)
    return union


_OBJECTS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
    ]
)


def list_objects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, length, modificationTime`` of every file below ``path``; contents are not read.

    A folder that does not exist has no files. Files without content, and those whose name starts
    with ``_`` or ``.``, are not listed.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
    )
    try:
        return reader.load(path).select(_OBJECTS.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _OBJECTS)


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted; names of folders, not what they hold."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])
