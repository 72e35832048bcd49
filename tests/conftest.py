from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

from hitledger.session import configure_session


def new_session() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="hitledger-test-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("hitledger-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure_session(spark)


@pytest.fixture(scope="session")
def spark():
    session = new_session()
    yield session
    session.stop()
