from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rowfold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("work")
    session = build_session(
        "rowfold-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__checkpoint__dir=f"file://{work}/shared",
        spark__sql__warehouse__dir=f"file://{work}/warehouse",
        spark__driver__memory="6g",
        spark__driver__bindAddress="127.0.0.1",
        spark__driver__host="127.0.0.1",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
