from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from headway.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", 8, 4, **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.sql.maxMetadataStringLength": "4000"})
    yield session
    session.stop()


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().toString()


@pytest.fixture
def physical():
    return plan_of
