import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "3g"}
    b = SparkSession.builder.master("local[4]").appName("tests")
    for k, v in conf.items():
        b = b.config(k, v)
    from chronoweave.plans.pipeline import session

    s = session(b)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
