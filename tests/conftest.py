import os
import tempfile
from pathlib import Path

import pytest
from basket_spark.sources import shared
from pyspark.sql import SparkSession


os.environ["PYTHONPATH"] = f"{Path(__file__).parent.parent}:{os.environ.get('PYTHONPATH', '')}"  # for Spark's Python workers


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="spark-warehouse-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-shared-"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    shared.clear(session)
    session.stop()
