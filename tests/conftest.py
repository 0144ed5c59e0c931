import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratus.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # Shared folder for sinks: a cluster names its own; here it is a local one.
    session = build_session(master="local[*]", shuffle_partitions=8, extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="stratus-test-")})
    yield session


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="stratus-t-", dir="/tmp")
