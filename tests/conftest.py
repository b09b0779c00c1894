import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from skiff.session import build_session

    work = tempfile.mkdtemp(prefix="skiff-tests-")
    s = build_session(
        master="local[4]",
        app_name="skiff-tests",
        shuffle_partitions=8,
        driver_memory="4g",
        extra={
            "spark.sql.warehouse.dir": os.path.join(work, "warehouse"),
            "spark.checkpoint.dir": os.path.join(work, "checkpoints"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={work}",
        },
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="skiff-t-")
