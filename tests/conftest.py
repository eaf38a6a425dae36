import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from starloom.session import build_session

    ckpt = tempfile.mkdtemp(prefix="starloom-test-ckpt-")
    warehouse = tempfile.mkdtemp(prefix="starloom-test-catalog-")
    s = build_session(
        "local[4]",
        shuffle_partitions=4,
        conf={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": warehouse},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="starloom-test-")
