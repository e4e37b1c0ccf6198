import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from folioflow.session import build_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of an expression over rows given as tuples."""

    def run(expression, rows, schema):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "_i int, " + schema)
        return [r["v"] for r in df.select("_i", expression.alias("v")).orderBy("_i").collect()]

    return run
