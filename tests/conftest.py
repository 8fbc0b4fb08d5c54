from __future__ import annotations

import tempfile

import pytest

from ledgerlake.session import build_session

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=warehouse,
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def smoke():
    return SMOKE


def rows(frame, *columns) -> list[tuple]:
    """Rows of a small frame as sorted tuples."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
