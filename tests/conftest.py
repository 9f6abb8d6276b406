import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from weftline.session import build_session

    session = build_session("tests", "local[*]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """column(fn, *values): the results of a Column function over single texts."""
    def run(fn, *values):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
        return [r["x"] for r in rows.select("i", fn("c").alias("x")).orderBy("i").collect()]
    return run
