import tempfile

import pytest

from pulse.session import build_session

# Built on import: test modules state column expressions at module level.
SESSION = build_session(
    "tests",
    **{
        "spark.master": "local[8]",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.log.level": "ERROR",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="pulse-tests-"),
    },
)


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def column(spark):
    """Values of a column expression over one text (or other) column ``x``."""

    def run(values, expression, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, x {kind}").select("i", expression.alias("y"))
        return [r["y"] for r in df.orderBy("i").collect()]

    return run
