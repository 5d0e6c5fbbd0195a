from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from casebook import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "casebook-tests",
        master=os.environ.get("TEST_MASTER", "local[8]"),
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.session.timeZone": os.environ.get("TEST_TIME_ZONE", "UTC"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def run_dir(tmp_path):
    return str(tmp_path)
