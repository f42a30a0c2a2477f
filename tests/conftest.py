import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyhouse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests", "local[8]", 8,
        {
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.sql.streaming.stateStore.maintenanceInterval": "10m",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
