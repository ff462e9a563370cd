"""A daily table in buckets: a merge shuffles its source only, never the old rows.

The files of a day are split by the hash of ``BUCKET_KEYS``. An ad has one row a day, so a bucket's
largest key is bounded by the calendar. The old rows of a bucket meet the source's keys of the same
bucket in one task, which sorts and spills, and writes the bucket's files of the touched days.

``<path>/buckets-<n>`` holds the rows with a whole key. Rows that lack a part of it would all hash to
one bucket; they match nothing, so they lie apart in ``<path>/loose``, as a plain daily table.
The number of buckets stays as it was when the table was made: another one is refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from adledger import registry
from adledger.operators.upsert import _missing, _on_days, _source_facts, append_rows, ensure_table, read_table
from adledger.registry import PARTITION, UPSERT_KEYS
from adledger.storage import staged

BUCKET_KEYS = ("account_id", "ad_id")


def buckets_for(table_bytes: int, days: int, file_bytes: int = 256 * 1024**2) -> int:
    """Buckets that give files of about ``file_bytes`` in a day of average size."""
    return max(1, round(table_bytes / max(days, 1) / file_bytes))


def _name(path: str) -> str:
    return "bucketed_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def buckets_of(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of the table at ``path``; None if there is no table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    found = [int(n[8:]) for n in names if n.startswith("buckets-") and n[8:].isdigit()]
    return found[0] if found else None


def ensure(spark: SparkSession, path: str, n_buckets: int | None = None, schema: T.StructType | None = None) -> str:
    """Make the table if it is absent, and return its name in the session's catalog.

    Raises if the table has another number of buckets: its files would be taken for wrong buckets.
    """
    schema = schema or registry.schema_for("insights")
    known = buckets_of(spark, path)
    if known is None and n_buckets is None:
        raise ValueError(f"no bucketed table at {path}; say how many buckets it is to have")
    if known is not None and n_buckets not in (None, known):
        raise ValueError(f"{path} has {known} buckets, not {n_buckets}")
    n = known or n_buckets
    name, files = _name(path), f"{path}/buckets-{n}"
    ensure_table(spark, files, schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet "
        f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({PARTITION}) "
        f"CLUSTERED BY ({', '.join(BUCKET_KEYS)}) INTO {n} BUCKETS LOCATION '{files}'"
    )
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return name


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows, those without a whole key included."""
    schema = schema or registry.schema_for("insights")
    rows = spark.table(ensure(spark, path, schema=schema)).select(*schema.names)
    ensure_table(spark, f"{path}/loose", schema)
    return rows.unionByName(read_table(spark, f"{path}/loose", schema))


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Let a join on more columns than the buckets' own use the buckets."""
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def merged(old: DataFrame, src: DataFrame, n_buckets: int, keys: Sequence[str] = UPSERT_KEYS) -> DataFrame:
    """All of ``src``, and the rows of the bucketed table ``old`` whose key it does not have.

    Both sides of the union come by bucket, so a task writes few files. A merge join, whose tasks
    spill, is asked for: a broadcast would read files without regard to their buckets.
    """
    by_bucket = src.repartition(n_buckets, *BUCKET_KEYS)
    kept = old.join(by_bucket.select(*keys).hint("merge"), list(keys), "left_anti")
    return kept.select(*src.columns).unionByName(by_bucket)


def upsert(
    src: DataFrame,
    path: str,
    n_buckets: int | None = None,
    schema: T.StructType | None = None,
    keys: Sequence[str] = UPSERT_KEYS,
    is_staged: bool = False,
) -> dict:
    """``upsert.upsert`` on a bucketed table: the same rows and the same counts.

    ``keys`` must hold the bucket's keys and the day. Rows that lack a part of the key come last.
    """
    if not {*BUCKET_KEYS, PARTITION} <= set(keys):
        raise ValueError(f"the key must hold {', '.join((*BUCKET_KEYS, PARTITION))}")
    schema = schema or registry.schema_for("insights")
    src = registry.conform(src, schema)
    if not is_staged:
        with staged(src, "merge-source") as stored:
            return upsert(stored, path, n_buckets, schema, keys, is_staged=True)
    spark = src.sparkSession
    processed, days, _ = _source_facts(src, keys)
    if processed == 0:
        return {"processed": 0, "status": "no_records"}
    name = ensure(spark, path, n_buckets, schema)
    whole = src.filter(~_missing(keys))
    if days:
        old = spark.table(name).filter(_on_days(days))
        with co_partitioned(spark):
            rows = merged(old, whole, buckets_of(spark, path), keys)
            rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    loose = src.filter(_missing(keys))
    if not loose.isEmpty():
        append_rows(loose, f"{path}/loose")
    return {"processed": processed, "rows_affected": processed, "status": "success"}
