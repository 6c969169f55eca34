import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from meldspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """Evaluates a column of texts ``t`` row by row, results in input order."""

    def evaluate(values, column):
        df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
        return [row.v for row in df.select("i", column.alias("v")).orderBy("i").collect()]

    return evaluate
