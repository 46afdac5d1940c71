import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import Resources, session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def bundled(spark):
    return Resources(spark)


@pytest.fixture(scope="session")
def by_join(spark):
    """The same tables, looked up by joins."""
    return Resources(spark, lookup="join")


@pytest.fixture(scope="session")
def posts(spark):
    def make(*texts, language="en"):
        rows = [(f"{i:03d}", t, language) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "rowkey string, content string, language string")

    return make
