import os
import tempfile

import pytest

from lutrin.functions.privacy import Salts
from lutrin.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.lutrin.buckets": "4",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lutrin-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def salts():
    return Salts("p", "s")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(v) for v in r))


def plan_of(df):
    return df._jdf.queryExecution().toString()
