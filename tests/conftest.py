from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from coursegrain.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from coursegrain.bindings.registry import Tables

    return Tables(spark, SMALL)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: [str(v) for v in r])

    return collect


@pytest.fixture
def one():
    """The only row of a frame as a dictionary."""

    def collect(df):
        (row,) = df.collect()
        return row.asDict()

    return collect
