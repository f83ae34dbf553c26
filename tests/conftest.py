import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package too.
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from triplake.session import get_spark

    import tempfile

    s = get_spark(
        "triplake-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="triplake-wh-"),
        },
    )
    yield s
    s.stop()
