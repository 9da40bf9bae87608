import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

_TESTS = os.path.dirname(os.path.abspath(__file__))
_REPO = os.path.dirname(_TESTS)
sys.path.insert(0, _REPO)
# Python workers import the package and the clients defined in tests.
os.environ["PYTHONPATH"] = os.pathsep.join([_REPO, _TESTS, os.environ.get("PYTHONPATH", "")])

AS_OF = "2024-01-01T00:00:00"
AS_OF_TIME = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
