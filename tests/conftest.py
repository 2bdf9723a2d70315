import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from staylens.session import get_session
    s = get_session("local[4]", app="staylens-tests", shuffle_partitions=4, driver_memory="4g",
                    extra={"spark.ui.showConsoleProgress": "false",
                           "spark.sql.autoBroadcastJoinThreshold": "10m"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="staylens-test-")
