import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bidlines.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "bidlines-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *cols):
        df = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect


@pytest.fixture
def value(spark):
    """Value of a column expression."""
    return lambda column: spark.range(1).select(column.alias("v")).first()["v"]
