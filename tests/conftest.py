from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from agorameter.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """A table ``(id, text)`` from a list of texts."""

    def make(values):
        return spark.createDataFrame(list(enumerate(values)), "id int, text string")

    return make


@pytest.fixture
def messages(spark):
    """A table ``(id, value)`` of message bytes from a list of JSON texts."""

    def make(values):
        rows = [(i, None if v is None else bytearray(v, "utf-8")) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "id int, value binary")

    return make


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
