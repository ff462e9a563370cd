"""Writes to the daily table: upsert, update-only, append and table set-up.

The table is Parquet, partitioned by day. A merge reads and rewrites only the day
partitions its source touches, in one job with dynamic partition overwrite. A catalog
with row-level operations can use ``merge_into`` instead.

The source must be unique on the key (checked; a merge has no defined result otherwise),
and so must the table. Rows with a missing key match nothing and are always inserted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from adledger import registry
from adledger.functions.parsing import parse
from adledger.operators import validate
from adledger.registry import LEGACY_KEYS, PARTITION, UPSERT_KEYS
from adledger.storage import stage, staged


# -- table set-up ----------------------------------------------------------------


def ensure_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> None:
    """Create the table if it is absent."""
    schema = schema or registry.schema_for("insights")
    by = [PARTITION] if PARTITION in schema.names else []
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*by).parquet(path)


def register_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType | None = None
) -> None:
    """Enter the table in the catalog under ``name``, or bring its list of days up to date."""
    schema = schema or registry.schema_for("insights")
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    by = f"PARTITIONED BY ({PARTITION})" if PARTITION in schema.names else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet {by} LOCATION '{path}'"
    )
    if by:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table with its declared types (folder names would be retyped otherwise)."""
    schema = schema or registry.schema_for("insights")
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def clone_schema(spark: SparkSession, source: DataFrame, path: str) -> DataFrame:
    """An empty table with the columns of another."""
    ensure_table(spark, path, source.schema)
    return read_table(spark, path, source.schema)


def route_table(name: str, dataset: str = "ads") -> str:
    """A bare table name gets the dataset in front; a qualified one stays."""
    return name if "." in name else f"{dataset}.{name}"


# -- merge -----------------------------------------------------------------------


def _missing(keys: Sequence[str]) -> Column:
    return reduce(or_, (F.col(k).isNull() for k in keys))


def _source_facts(src: DataFrame, keys: Sequence[str]) -> tuple[int, list, int]:
    """Rows, touched days and undated rows of a staged source; raises if a key comes twice.

    One pass over the key columns. What reaches the driver is one row: its list of days
    is bounded by the calendar, not by the data.
    """
    fact = (
        src.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.coalesce(F.max(F.when(~_missing(keys), F.col("n"))), F.lit(0)).alias("most"),
            F.collect_set(PARTITION).alias("days"),
            F.coalesce(F.sum(F.when(F.col(PARTITION).isNull(), F.col("n"))), F.lit(0)).alias("undated"),
        )
        .first()
    )
    if fact["most"] > 1:
        raise ValueError(f"merge source has several rows for one key {tuple(keys)}")
    return fact["n"], sorted(fact["days"]), fact["undated"]


def _on_days(days: list) -> Column:
    """Exactly the touched days, however many: others are neither read nor rewritten."""
    if not days:
        return F.lit(False)
    return F.col(PARTITION).isin(days)


def _by_day(rows: DataFrame, n_days: int) -> DataFrame:
    """Bring the rows of a day together, in tasks of the advisory size.

    Adaptive execution splits a large day and merges small ones. A split cuts through a
    whole shuffle partition, and any other day in it would end up in as many small files;
    so there are far more partitions than days, and two days rarely share one.
    """
    return rows.hint("rebalance", 64 * n_days, PARTITION)


def _overwrite_days(rows: DataFrame, path: str, n_days: int) -> None:
    """Replace the day partitions of ``rows``."""
    (
        _by_day(rows, n_days)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def append_rows(rows: DataFrame, path: str, n_days: int = 31) -> None:
    """Append to the table, with files of a sensible size per day (``n_days``: about how many)."""
    _by_day(rows, n_days).write.mode("append").partitionBy(PARTITION).parquet(path)


def overwrite_then_append(first: DataFrame, others: Sequence[DataFrame], path: str) -> None:
    """Load a staging table: the first batch replaces its content, the others add to it."""
    (
        _by_day(first, n_days=31)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(PARTITION)
        .parquet(path)
    )
    for batch in others:
        append_rows(batch, path)


def merged(old: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All of ``src``, and the old rows whose key it does not have."""
    new_keys = src.filter(~_missing(keys)).select(*keys)
    kept = old.filter(~_missing(keys)).join(new_keys, list(keys), "left_anti").select(*old.columns)
    # Rows that match nothing stay apart, so that they do not all meet in one join task.
    return kept.unionByName(old.filter(_missing(keys))).unionByName(src)


def upsert(
    src: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    keys: Sequence[str] = UPSERT_KEYS,
    is_staged: bool = False,
) -> dict:
    """Merge ``src``: replace matched rows as a whole, insert the others.

    ``is_staged`` says that ``src`` is read from storage already; otherwise it is staged for
    the time of the merge, because the key check and the write both read it. Old rows of the
    touched days are kept if no source row has their key; the source is never joined on its
    full width. Rows without a day match nothing, so they are appended and their partition is
    not rewritten; that comes last, so that a run that failed before it can be repeated.
    """
    schema = schema or registry.schema_for("insights")
    src = registry.conform(src, schema)
    if not is_staged:
        with staged(src, "merge-source") as stored:
            return upsert(stored, path, schema, keys, is_staged=True)
    spark = src.sparkSession
    processed, days, n_undated = _source_facts(src, keys)
    if processed == 0:
        return {"processed": 0, "status": "no_records"}
    ensure_table(spark, path, schema)

    if days:
        old = read_table(spark, path, schema).filter(_on_days(days))
        _overwrite_days(merged(old, src.filter(F.col(PARTITION).isNotNull()), keys), path, len(days))
    if n_undated:
        append_rows(src.filter(F.col(PARTITION).isNull()), path)
    return {"processed": processed, "rows_affected": processed, "status": "success"}


def update_only(
    src: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    keys: Sequence[str] = LEGACY_KEYS,
    is_staged: bool = False,
) -> int:
    """Replace the non-key columns of matched table rows; insert nothing."""
    schema = schema or registry.schema_for("insights")
    src = registry.conform(src, schema)
    if not is_staged:
        with staged(src, "update-source") as stored:
            return update_only(stored, path, schema, keys, is_staged=True)
    processed, days, _ = _source_facts(src, keys)
    if not days:
        return processed
    old = read_table(src.sparkSession, path, schema).filter(_on_days(days))
    values = registry.updatable_columns(old, tuple(keys))
    new = src.filter(~_missing(keys)).select(*keys, F.struct(*values).alias("_new"))
    matched = F.col("_new").isNotNull()
    updated = (
        old.filter(~_missing(keys))
        .join(new, list(keys), "left")
        .select(*keys, *(F.when(matched, F.col("_new")[c]).otherwise(F.col(c)).alias(c) for c in values))
    )
    unmatched = old.filter(_missing(keys))
    _overwrite_days(updated.select(*schema.names).unionByName(unmatched), path, len(days))
    return processed


def _on_days_of(target: DataFrame, src: DataFrame) -> DataFrame:
    """Table rows of exactly the days of ``src``, which the calendar bounds; reads its days once."""
    days = [r[0] for r in src.select(PARTITION).where(F.col(PARTITION).isNotNull()).distinct().collect()]
    return target.filter(_on_days(sorted(days)))


def merge_counts(
    target: DataFrame, src: DataFrame, keys: Sequence[str] = UPSERT_KEYS
) -> DataFrame:
    """What a merge would do, from the keys alone: processed, updated, inserted, affected."""
    known = _on_days_of(target.select(*keys), src)
    matched = src.select(*keys).join(known, list(keys), "left_semi")
    updated = matched.agg(F.count(F.lit(1))).scalar()
    counts = src.agg(F.count(F.lit(1)).alias("processed"))
    return counts.select(
        "processed",
        updated.alias("updated"),
        (F.col("processed") - updated).alias("inserted"),
        F.col("processed").alias("rows_affected"),
    )


def merge_into(
    src: DataFrame, table: str, keys: Sequence[str] = UPSERT_KEYS, insert: bool = True
) -> None:
    """The same merge on a catalog table with row-level operations.

    ``insert=False`` only updates. Built-in Parquet tables do not support this.
    """
    target = table.split(".")[-1]
    condition = reduce(
        lambda a, b: a & b, (F.col(f"{target}.{k}") == F.col(f"source.{k}") for k in keys)
    )
    values = {c: F.col(f"source.{c}") for c in src.columns}
    changes = {c: v for c, v in values.items() if c not in keys}
    merge = src.alias("source").mergeInto(table, condition)
    merge = merge.whenMatched().update(changes)
    if insert:
        merge = merge.whenNotMatched().insert(values)
    merge.merge()


# -- older split into updates and inserts ------------------------------------------


def run_sql(spark: SparkSession, query: str, args: dict | list | None = None, **frames):
    """Run a statement with typed parameters; frames are visible under their names."""
    return spark.sql(query, args=args, **frames)


def existing_records(
    target: DataFrame,
    date_starts: Sequence | DataFrame,
    date_stops: Sequence | DataFrame,
    ad_ids: Sequence | DataFrame,
) -> DataFrame:
    """Key columns of rows that pass three separate IN tests (a superset of the tuples).

    Listed values reach the scan; values that may be many come as a one-column frame and
    become a semi join.
    """
    out = target.select(*LEGACY_KEYS)
    for column, wanted in zip(LEGACY_KEYS, (date_starts, date_stops, ad_ids)):
        if isinstance(wanted, DataFrame):
            wanted = wanted.toDF(column).distinct()
            if column == PARTITION:
                out = _on_days_of(out, wanted)
            out = out.join(wanted, column, "left_semi")
        else:
            out = out.filter(F.col(column).isin(list(wanted)))
    return out.select(*LEGACY_KEYS)


def split_known(
    new: DataFrame, existing: DataFrame, keys: Sequence[str] = LEGACY_KEYS
) -> tuple[DataFrame, DataFrame]:
    """New rows whose key exists (updates) and the others (inserts).

    Days of typed existing rows are compared as ``yyyy-MM-dd`` text, and exactly the days of the
    new rows are read. A missing key is an insert; those rows skip the join. The new rows are
    stored once, as days, updates and inserts all read them.
    """
    new = stage(new, "split-source")
    if PARTITION in keys and isinstance(existing.schema[PARTITION].dataType, T.DateType):
        existing = _on_days_of(existing, new.select(parse("date", PARTITION).alias(PARTITION)))
    known = existing.select(
        *(
            F.date_format(k, "yyyy-MM-dd").alias(k)
            if isinstance(existing.schema[k].dataType, T.DateType)
            else F.col(k)
            for k in keys
        )
    )
    complete = new.filter(~_missing(keys))
    updates = complete.join(known, list(keys), "left_semi").select(*new.columns)
    inserts = complete.join(known, list(keys), "left_anti").select(*new.columns)
    return updates, inserts.unionByName(new.filter(_missing(keys)))


def append_with_rejects(
    rows: DataFrame, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Append the rows that fit the table; return the others with their issues."""
    schema = schema or registry.schema_for("insights")
    checked = stage_checked(validate.check(rows), schema)
    append_rows(checked.filter("_ok").select(*schema.names), path)
    return checked.filter("NOT _ok").select("_order", "record", "issues")


def stage_checked(
    checked: DataFrame, schema: T.StructType, order: str = "_seq", path: str | None = None
) -> DataFrame:
    """Store checked rows once: usable ones typed, the others as JSON with their issues.

    Both the table write and the quarantine read this, so scan, deduplication and checks
    run once. The verdict is the partition, which makes the counts cheap.
    """
    typed = [
        f"CAST({f'IF(_ok, `_typed_{f.name}`, NULL)' if f'_typed_{f.name}' in checked.columns else 'NULL'} "
        f"AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in schema.fields
    ]
    return stage(
        checked.select(
            *map(F.expr, typed),
            F.col(order).alias("_order"),
            F.when(~F.col("_ok"), validate.record_json(checked)).alias("record"),
            F.expr("IF(_ok, NULL, _issues)").alias("issues"),
            "_ok",
        ),
        "checked",
        ("_ok",),
        path,
    )
