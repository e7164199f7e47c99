from __future__ import annotations

import os
import sys
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from subscore.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        4,
        **{
            "spark.checkpoint.dir": str(work / "shared"),
            "spark.sql.warehouse.dir": str(work / "warehouse"),
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_folder():
    if not os.path.isdir(TESTDATA):
        pytest.skip(f"no test tables in {TESTDATA}")
    return TESTDATA


@pytest.fixture
def as_of():
    return date(2019, 9, 15)


def rows(df, *order):
    """Rows as tuples, sorted by the given columns or as they compare as text."""
    collected = [tuple(r) for r in df.collect()]
    if order:
        positions = [df.columns.index(c) for c in order]
        return sorted(collected, key=lambda r: tuple(str(r[p]) for p in positions))
    return sorted(collected, key=str)
