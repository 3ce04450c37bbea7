from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from sentilode.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        spark__master=f"local[{os.environ.get('TEST_CPUS', '8')}]",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
