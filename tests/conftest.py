import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from resalelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of column expressions over literal rows of one text column ``v``."""

    def run(values, *columns):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, v string")
        got = df.select("i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
        return [tuple(r[1:]) if len(columns) > 1 else r[1] for r in got]

    return run
