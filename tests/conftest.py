import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tarnwater.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.log.level": "ERROR", "spark.ui.showConsoleProgress": "false"},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
