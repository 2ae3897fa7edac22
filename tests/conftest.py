from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession


def local_session() -> SparkSession:
    work = tempfile.mkdtemp(prefix="fundflow-test-")
    return (
        SparkSession.builder.master("local[8]")
        .appName("fundflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .config("spark.checkpoint.dir", f"{work}/checkpoint")
        .getOrCreate()
    )


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
