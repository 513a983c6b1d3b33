import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corbel.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    builder = SparkSession.builder.master("local[8]").appName("tests")
    session = configure(
        builder,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    ).getOrCreate()
    yield session
    session.stop()


def plan_of(df):
    """Physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
