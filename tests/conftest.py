"""One local session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lodestrata.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__checkpoint__dir=f"file://{shared}", spark__sql__warehouse__dir=str(shared / "warehouse"), spark__default__parallelism="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
