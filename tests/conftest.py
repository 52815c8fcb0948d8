from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from odsflow.session import local_session  # noqa: E402
from odsflow.sources.driver import DriverTables  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "odsflow-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return DriverTables(spark, DATA)


@pytest.fixture
def no_broadcast(spark):
    """Take the ways meant for tables that are too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
