from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sealframe.session import cipher_options


def session() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="sealframe-tests-")
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", Path(scratch, "shared").as_uri())
        .config("spark.sql.warehouse.dir", Path(scratch, "warehouse").as_uri())
    )
    for name, value in cipher_options().items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    spark = session()
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def key() -> bytes:
    return os.urandom(32)
