import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wayfare.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new folder for files; left behind for inspection."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def plan():
    """The physical plan of a DataFrame as text, after it ran."""

    def text(df, run: bool = False) -> str:
        if run:
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
