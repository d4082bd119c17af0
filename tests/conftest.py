from __future__ import annotations

import os
import pathlib
import sys
import time

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


# Collected timestamps come back in the process time zone.
os.environ["TZ"] = "UTC"
time.tzset()


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tallylog-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return local_session()
