from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskweave import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "riskweave-tests", "local[4]",
        **{
            "spark.driver.memory": "4g", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def dwd(spark, sf):
    from riskweave.session import staged
    from riskweave.sources import adapters as A

    return staged(A.detail(spark, sf), "detail")


@pytest.fixture(scope="session")
def rows(spark):
    """Build a small frame: rows(schema, [tuple, ...])."""
    return lambda schema, data: spark.createDataFrame(data, schema)
