import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark():
    from curlew.session import session, ship

    s = session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1"})
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    return s
