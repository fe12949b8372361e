from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulsework.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="pulsework-test-")
    session = build_session(
        "tests",
        master="local[4]",
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": f"{warehouse}/warehouse",
            "spark.checkpoint.dir": f"{warehouse}/work",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path) -> str:
    return str(tmp_path)


@pytest.fixture
def unique():
    import uuid

    return lambda label: f"{label}_{uuid.uuid4().hex}"
