import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridsteps.session import configure  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = configure(
        SparkSession.builder.master("local[8]").appName("gridsteps-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.showConsoleProgress", "false")
    ).getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
