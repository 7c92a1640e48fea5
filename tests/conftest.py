import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from edictum.session import configure  # noqa: E402

# Made here, so that test modules can name columns when they are imported.
SESSION = configure(
    SparkSession.builder.master("local[8]")
    .appName("tests")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.driver.memory", "6g")
    .getOrCreate()
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def values(spark):
    """Evaluate an expression over a column ``v`` of literal values."""

    def run(expression, rows, kind="string"):
        df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
        return [r[1] for r in sorted(df.select("i", expression.alias("x")).collect(), key=lambda r: r[0])]

    return run
