import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from haulmark.schemas import RAW_SCHEMA, ddl  # noqa: E402
from haulmark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Raw records as a frame in the declared types."""

    def make(*records):
        rows = [tuple(row[name] for name in RAW_SCHEMA) for row in records]
        return spark.createDataFrame(rows, ddl(RAW_SCHEMA)).coalesce(1)

    return make
