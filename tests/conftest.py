import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def event_log_dir():
    return tempfile.mkdtemp(prefix="tl-events-")


@pytest.fixture(scope="session")
def spark(event_log_dir):
    from trafficlens.session import build_session
    s = build_session("local[4]", app="trafficlens-tests", shuffle_partitions=8, extra={
        "spark.driver.memory": "8g",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": event_log_dir,
        "spark.eventLog.rolling.enabled": "false",
        "spark.eventLog.compress": "false",
    })
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="tl-test-")
