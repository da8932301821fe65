"""Small helpers that the operators share: reading, shared folders, groups of task input."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from sealframe.session import package_on_workers, shared_folder

# White space between words: space and the five control characters from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def kept(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows as a table in the cluster's shared folder, which cuts the lineage.

    A lost executor takes no rows with it, and what reads them does not compute them again. ``folder``
    is one that is removed later (``staging_folder``), for rows that the result does not need.
    """
    spark = df.sparkSession
    path = f"{folder}/{uuid.uuid4().hex}" if folder else f"{shared_folder(spark)}/kept"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions: the operator's groups grow with them, as a cluster's set-up does."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_package(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``query(spark, ...)`` with Python workers that find this package beside the driver's copy."""
    @wraps(query)
    def run(spark: SparkSession, *more, **named) -> DataFrame:
        package_on_workers(spark)
        return query(spark, *more, **named)

    return run
