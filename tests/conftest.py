from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import SparkSession

from attesta.session import SETTINGS


def build_session() -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]").appName("attesta-tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "12g").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="attesta-test-")))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return build_session()
