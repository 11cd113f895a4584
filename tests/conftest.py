import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from harkline.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="harkline-test-")
