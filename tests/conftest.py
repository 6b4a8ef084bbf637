from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starloom.session import build_session
    warehouse = tempfile.mkdtemp(prefix="starloom-wh-")
    session = build_session("local[4]", app="starloom-tests", shuffle_partitions=8,
                            extra={"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture
def small_keys(spark):
    """Many key ranges for tiny inputs."""
    per = "starloom.keys.rowsPerRange"
    spark.conf.set(per, "3")
    yield
    spark.conf.unset(per)
