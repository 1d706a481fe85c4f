from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session, clear_scratch
from tidemark.settings import for_environment


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", 4, "local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def settings(tmp_path):
    return for_environment(str(tmp_path / "lake"))
