"""Stored tables that change in one step: folders of their own and a numbered version that names them.

A table's root holds data folders and ``_versions/<number>.json``. A version is committed by moving one small
file to a name that must not exist yet; readers follow the highest number. A writer that fails leaves folders no
version names, and of two writers that start from one version only one commits.
"""

from __future__ import annotations

import json
import re
import uuid
from typing import Any, NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

VERSIONS = "_versions"
# Versions before the current one that stay, for those who still read them.
KEPT = 1


class Version(NamedTuple):
    """``folders`` by role, relative to the root, and whatever else the writer noted."""

    number: int
    folders: dict[str, list[str]]
    notes: dict[str, Any]


class Conflict(RuntimeError):
    """Another writer committed first."""


def _hadoop(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(context._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder, files = _hadoop(spark, f"{root}/{VERSIONS}")
    try:
        names = [status.getPath().getName() for status in files.listStatus(folder)]
    except Py4JJavaError as error:
        if "FileNotFoundException" not in str(error.java_exception):
            raise
        return []
    return sorted(int(name[:-5]) for name in names if re.fullmatch(r"\d+\.json", name))


def _read(spark: SparkSession, root: str, number: int) -> Version:
    path, files = _hadoop(spark, f"{root}/{VERSIONS}/{number:012d}.json")
    stream = files.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    held = json.loads(text)
    return Version(number, held["folders"], held["notes"])


def current(spark: SparkSession, root: str) -> Version | None:
    """The newest committed version; None before the first."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else None


def commit(
    spark: SparkSession, root: str, folders: dict[str, list[str]], notes: dict[str, Any] | None = None, after: int = 0
) -> Version:
    """Make ``folders`` the version that follows number ``after`` (0: the first), or raise ``Conflict``."""
    root, number = root.rstrip("/"), after + 1
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    draft, files = _hadoop(spark, f"{root}/{VERSIONS}/.{uuid.uuid4()}")
    target, _ = _hadoop(spark, f"{root}/{VERSIONS}/{number:012d}.json")
    stream = files.create(draft, False)
    stream.write(json.dumps({"folders": folders, "notes": notes or {}}).encode())
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), configuration)
    # without the option to overwrite a move to a taken name fails
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, target, options)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if number in _numbers(spark, root):
            raise Conflict(f"version {number} of {root} is taken") from error
        raise
    return Version(number, folders, notes or {})


def new_folder(version: Version | None) -> str:
    """Name for a data folder of the version that follows."""
    return f"v{(version.number if version else 0) + 1}-{uuid.uuid4()}"


def clean(spark: SparkSession, root: str) -> None:
    """Remove what neither the current version nor the KEPT ones before it name.

    Folders of a higher number belong to a writer at work. One of the current number or below that no version names
    was left by a writer that failed or came second.
    """
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    if not numbers:
        return
    kept = [_read(spark, root, number) for number in numbers[-1 - KEPT :]]
    named = {folder for version in kept for folders in version.folders.values() for folder in folders}
    top, files = _hadoop(spark, root)
    for status in files.listStatus(top):
        name = status.getPath().getName()
        made = re.match(r"v(\d+)-", name)
        if made and name not in named and int(made[1]) <= numbers[-1]:
            files.delete(status.getPath(), True)
    for number in numbers[: -1 - KEPT]:
        path, _ = _hadoop(spark, f"{root}/{VERSIONS}/{number:012d}.json")
        files.delete(path, False)


def read(spark: SparkSession, root: str, schema: StructType | None = None, role: str = "table") -> DataFrame:
    """The current version's folders of one role as a table."""
    version = current(spark, root)
    if version is None:
        raise FileNotFoundError(f"no version of {root}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*[f"{root.rstrip('/')}/{folder}" for folder in version.folders[role]])


def replace(frame: DataFrame, root: str, **options: str) -> DataFrame:
    """Store ``frame`` as the whole table and return it as read back.

    Until the data is complete the old version is the table, also if the job fails.
    """
    spark, root = frame.sparkSession, root.rstrip("/")
    before = current(spark, root)
    folder = new_folder(before)
    frame.write.options(**options).parquet(f"{root}/{folder}")
    commit(spark, root, {"table": [folder]}, after=before.number if before else 0)
    clean(spark, root)
    return spark.read.schema(frame.schema).parquet(f"{root}/{folder}")
