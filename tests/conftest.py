from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plumbline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("plumbline-tests", cores=4, partitions=3)
    session.sparkContext.setLogLevel("ERROR")
    # Tiny inputs: compiling each plan would take most of the time.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()
