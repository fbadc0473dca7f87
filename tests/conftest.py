from __future__ import annotations

import pytest

from ledgerloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def seeds(spark):
    from ledgerloom.sources.seeds import built_in_seeds

    return built_in_seeds(spark)
