import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from tallyspark.session import build_session

    s = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
