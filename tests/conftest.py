import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eventide.session import local_session

    s = local_session(4, shuffle_partitions=8, app_name="eventide-tests")
    # Use the configured spark.checkpoint.dir; only where it is unset do the
    # tests set their own folder.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventide-test-ckpt-"))
    yield s
    s.stop()


def have_testdata(sf=SF001):
    return os.path.exists(f"{sf}/events.parquet")
