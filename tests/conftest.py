from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from clickscope.session import build_session

    warehouse = tempfile.mkdtemp(prefix="clickscope-warehouse-")
    session = build_session(
        master="local[*]",
        shuffle_partitions=8,
        app_name="clickscope-tests",
        conf={"spark.sql.warehouse.dir": warehouse},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def golden(spark):
    from tests.golden import golden_tables

    return golden_tables(spark)


def sf_dir(sf: str) -> str:
    return f"{TESTDATA}/sf{sf}"
