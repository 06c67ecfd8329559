import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from mailtrail.session import engine_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = engine_session(
        "tests", master="local[4]", shuffle_partitions=4,
        **{"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
