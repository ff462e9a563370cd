"""Shared working storage: run folders and staged tables.

Intermediate results that are read more than once are written as Parquet below the
cluster's checkpoint folder. That cuts the lineage, survives lost executors, and
makes row counts a footer read. Nothing is kept on an executor's own disk.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Only a local session without either gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="adledger-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder path for one run."""
    return f"{shared_root(spark)}/adledger/{label}-{uuid.uuid4().hex}"


def stage(
    df: DataFrame, label: str, partition_by: tuple[str, ...] = (), path: str | None = None
) -> DataFrame:
    """Write ``df`` once and return the frame that reads it back.

    Give a ``path`` to be able to ``remove_folder`` it when nothing reads it any more.
    """
    path = path or run_folder(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a run folder of ours on whatever file system it is; absent is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``stage`` for the length of a block."""
    path = run_folder(df.sparkSession, label)
    try:
        yield stage(df, label, path=path)
    finally:
        remove_folder(df.sparkSession, path)
