import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shoplens.session import build_session, checkpoint_dir

    s = build_session("local[8]", extra={"spark.sql.shuffle.partitions": "8"})
    # tests only: the cluster names its shared folder in spark.checkpoint.dir
    checkpoint_dir(s, tempfile.mkdtemp(prefix="shoplens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="shoplens-test-")
