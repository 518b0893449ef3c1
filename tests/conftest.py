import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from roadlens.session import local_session

    s = local_session(
        "*", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false",
                "spark.sql.streaming.stateStore.providerClass":
                    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="roadlens-test-", dir="/tmp")
