"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# Bytes that a map task reads and a shuffle partition holds at large sizes, and that files get.
MAP_BYTES = 2 * 1024**3
SHUFFLE_BYTES = 1024**3
FILE_BYTES = 256 * 1024**2
SMALL_INPUT = 1024**4


def size_for(spark: SparkSession, input_bytes: int, shuffled_bytes: int | None = None) -> None:
    """Set the numbers of tasks and the file sizes for a job.

    ``shuffled_bytes`` is what enters the shuffle after pruning and projection; the input's size
    stands for it if it is not known. The number of blocks is the product of map tasks and shuffle
    partitions, so both handle 1 to 2 GB. Adaptive execution merges partitions that turn out small.
    """
    shuffled = input_bytes if shuffled_bytes is None else shuffled_bytes
    partitions = max(spark.sparkContext.defaultParallelism, -(-shuffled // SHUFFLE_BYTES))
    # Below a terabyte there are few blocks anyway, and smaller tasks use more machines.
    split = MAP_BYTES if input_bytes >= SMALL_INPUT else FILE_BYTES
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(FILE_BYTES))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))


def build_session(master: str | None = None, app: str = "adledger", **conf: str) -> SparkSession:
    """A session with ``SETTINGS``; extra settings go in as ``spark_sql_x`` style keywords."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
