from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from drydock.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "drydock-tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false"
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def file_of(spark):
    """One build file as a frame."""

    def make(*contents):
        return spark.createDataFrame(list(enumerate(contents)), "file_id long, content string")

    return make
