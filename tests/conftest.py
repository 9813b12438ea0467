from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "tests",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.ui.showConsoleProgress": "false",
            # plan texts hold whole filters, however long the numbers of columns have become
            "spark.sql.maxMetadataStringLength": "1000",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted plain tuples of a small DataFrame."""

    def collect(df, *names):
        picked = df.select(*names) if names else df
        return sorted((tuple(row) for row in picked.collect()), key=str)

    return collect


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plan():
    return plan_text
