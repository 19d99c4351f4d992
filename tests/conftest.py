import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sentrylake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "sentrylake-tests", "local[4]", **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "10000", "spark.sql.maxPlanStringLength": "1000000",
        })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
