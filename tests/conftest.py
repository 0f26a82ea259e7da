import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from goldenrec.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a one-argument Column function to a list of texts."""

    def run(function, values):
        rows = [(i, v) for i, v in enumerate(values)]
        frame = spark.createDataFrame(rows, "i int, v string")
        found = frame.select("i", function("v").alias("r")).orderBy("i").collect()
        return [row["r"] for row in found]

    return run
