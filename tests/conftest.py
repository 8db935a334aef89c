from __future__ import annotations

import pytest

from skyledger.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "skyledger-tests",
        master="local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir=str(home / "warehouse"),
        spark__checkpoint__dir=str(home / "work"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
