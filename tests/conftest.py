import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catalograph.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[*]", {
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
