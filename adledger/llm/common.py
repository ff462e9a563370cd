"""What the operators share: tables, batch sizes for Python workers, label-free sampling."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A Python worker gets batches of about this size, whatever the number of rows.
BATCH_BYTES = 2 * 1024 * 1024
BATCH_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of the batches that Spark sends to Python workers in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch further, so that one slice holds about ``BATCH_BYTES`` or a single row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > BATCH_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def fold(key: str | Column, folds: int) -> Column:
    """The remainder that sets rows apart for tests: crc32 of the key as text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % folds


def share(key: str | Column) -> Column:
    """A number from 0 to 1 that depends on the key alone, to sample by."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
