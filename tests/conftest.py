from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from martlet.session import get_session

    session = get_session(
        "martlet-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra_conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="martlet-wh-")},
    )
    yield session
    session.stop()


@pytest.fixture()
def workdir(spark):
    from martlet.session import new_work_dir

    return new_work_dir(spark, "test")
