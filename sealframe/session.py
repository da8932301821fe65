"""Cluster settings the jobs read: parallelism, shared folder, cipher provider order."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PROVIDER_ORDER = Path(__file__).resolve().parent.parent / "conf" / "cipher-providers.properties"


def cipher_options() -> dict[str, str]:
    """Driver options for cell work, which in local mode are the executor's too.

    Every cipher cell looks its AES provider up; behind four other providers the look-ups
    contend between the threads of an executor. The many short-lived objects suit the parallel
    collector. On a cluster ship the file with ``--files`` and name it in
    ``spark.executor.extraJavaOptions``.
    """
    return {"spark.driver.extraJavaOptions": f"-Djava.security.properties={PROVIDER_ORDER} -XX:+UseParallelGC"}


def dealt(df: DataFrame, partitions: int | None) -> DataFrame:
    """``df`` in so many partitions, or as it was read where none are asked for.

    Cell work is bound by the processor: a table that comes as fewer partitions than there are cores
    is worth a shuffle before the cipher, on rows that a retried task reproduces. Only the caller
    knows that, so nothing is guessed from sizes or cores.
    """
    return df if partitions is None else df.repartition(partitions)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = Path(tempfile.mkdtemp(prefix="sealframe-")).as_uri()
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def package_on_workers(spark: SparkSession) -> None:
    """Python workers find this package beside the driver's copy.

    Where the executors have the package elsewhere, or from ``--py-files``, this changes nothing.
    """
    root = str(Path(__file__).resolve().parents[1])
    found = spark.sparkContext.environment
    paths = [p for p in found.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        found["PYTHONPATH"] = os.pathsep.join([*paths, root])


@contextmanager
def staging_folder(spark: SparkSession) -> Iterator[str]:
    """A shared folder that is removed at the end, whether or not the work succeeded."""
    folder = shared_folder(spark)
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
