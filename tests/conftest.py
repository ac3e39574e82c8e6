from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from costcurves.session import local_session

    scratch = tempfile.mkdtemp(prefix="costcurves-test-")
    s = local_session(master="local[4]", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.checkpoint.dir": "file://" + os.path.join(scratch, "shared"),
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE_DIR
