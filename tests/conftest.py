import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from starlog.session import build_session

    # without coalescing, small inputs are still cut into several blocks
    session = build_session(
        "starlog-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__warehouse__dir="/tmp/starlog-test-warehouse",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "out")
