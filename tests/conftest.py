from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hearthline.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="4g", app="hearthline-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def listings(spark, small):
    from checks import inputs

    return inputs.listings(spark, small)


@pytest.fixture
def frame(spark):
    """A DataFrame from rows and a DDL schema."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


def values(df, *names):
    """Rows as tuples, in the order of the first column."""
    picked = df.select(*names) if names else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: str(t[0]).zfill(12))
