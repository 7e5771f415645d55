from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from slumptrace.session import build_session

    folder = tmp_path_factory.mktemp("spark")
    session = build_session("tests", **{
        "spark.master": "local[8]",
        "spark.driver.memory": "4g",
        "spark.sql.shuffle.partitions": "3",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(folder / "warehouse"),
        "spark.checkpoint.dir": str(folder / "staging"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a frame from a DDL schema and rows."""

    def build(schema: str, *rows: tuple):
        return spark.createDataFrame(list(rows), schema)

    return build
