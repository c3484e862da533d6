import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from quire.session import ship

    own = tmp_path_factory.mktemp("spark")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "3g",
        "spark.sql.warehouse.dir": str(own / "warehouse"), "spark.checkpoint.dir": f"file://{own}/checkpoint",
    }
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
