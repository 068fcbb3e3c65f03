import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from tallycheck.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="tallycheck-tests-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    s = build_session(
        master="local[*,3]",  # up to 3 attempts per task, as on a cluster
        app_name="tallycheck-tests",
        shuffle_partitions=8,
        extra_conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples for multiset comparison."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
