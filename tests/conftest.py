"""One small session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.sql.codegen.wholeStage": "false", "spark.sql.adaptive.enabled": "false"})
    yield session
    session.stop()
