"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession


Result = TypeVar("Result")
# Independent jobs handed to Spark at the same time, so that one's last tasks do not idle the cluster.
CONCURRENT_JOBS = 4


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings this library expects; extra keyword settings win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # call sites are not recorded per Column: the seven specs build in half the time
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder of the cluster; a local session without one gets a fresh scratch folder."""
    context = spark.sparkContext
    path = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="goldenrec-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return path


_folders: set[str] = set()


def run_folder(spark: SparkSession) -> str:
    """Folder for the intermediate tables of this application, removed when the driver program ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/goldenrec/{spark.sparkContext.applicationId}"
    if path not in _folders:
        _folders.add(path)
        atexit.register(_remove_at_end, spark, path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables, wherever the session's file systems have it."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def _remove_at_end(spark: SparkSession, path: str) -> None:
    # a stopped context has no configuration any more; its folder then stays for the cluster's own cleaning
    if spark.sparkContext._jsc is not None:
        remove_folder(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (a layer boundary)."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def concurrently(jobs: Iterable[Callable[[], Result]]) -> list[Result]:
    """Results of independent Spark jobs, submitted side by side; the first failure is raised."""
    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        return list(pool.map(lambda job: job(), jobs))
