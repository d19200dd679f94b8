import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickerloom.session import get_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("checkpoint"))
    session = get_session(
        "tests",
        "local[8]",
        {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
         "spark.checkpoint.dir": shared},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def one(spark):
    """Evaluate columns over literal rows: ``one(rows, schema, column)`` -> list of values."""

    def run(rows, schema, column):
        return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]

    return run


@pytest.fixture
def texts(one):
    """Apply a text column builder to Python strings."""
    from pyspark.sql import functions as F

    return lambda build, values: one([(v,) for v in values], "x string", build(F.col("x")))
