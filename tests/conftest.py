from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tallyhouse.session import SESSION_SETTINGS  # noqa: E402

DATA_ROOT = os.environ.get("TALLYHOUSE_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("tallyhouse-tests")
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA_ROOT}/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return f"{DATA_ROOT}/sf0.01"
