from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

from linewatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "linewatch-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """``table("a int, b string", (1, "x"), ...)``"""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture
def rows():
    """Rows as sorted tuples."""
    return lambda df, *cols: sorted(
        (tuple(r) for r in (df.select(*cols) if cols else df).collect()),
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )
