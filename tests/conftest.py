import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    from tests.oracle import connect

    return connect(data)
