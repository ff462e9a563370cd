"""Incremental sync as a file stream: every landed file is read once, in the batch it arrives with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from adledger import registry
from adledger.operators import versions
from adledger.operators.upsert import stage_checked
from adledger.plans.sync import SyncConfig, prepared
from adledger.sources.landing import CORRUPT, ORDER, of_accounts
from adledger.storage import remove_folder, run_folder


def stream_sync(
    spark: SparkSession,
    config: SyncConfig,
    path: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    files_per_batch: int = 1000,
    name: str = "landing",
) -> list[dict]:
    """Take all files that have landed below ``path`` since the last run; a report per batch.

    Which files were read is kept in ``checkpoint``. A batch is deduplicated, checked and merged
    into the versioned table of ``config``, so that its rows replace those of earlier batches with
    the same key. Rows that do not pass go to the quarantine, under the batch. A batch that is
    replayed after a failure overwrites its quarantine and leaves a table alone that has it already,
    so it may fail anywhere. Lines that are not JSON count as rejected rows.
    """
    schema = schema or registry.landing_schema()
    lines = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    stream = (
        spark.readStream.schema(lines)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    )
    reports: list[dict] = []

    def take(rows: DataFrame, batch: int) -> None:
        reports.append(_merge_batch(config, rows, name, batch))

    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query.foreachBatch(take).start().awaitTermination()
    return reports


def _merge_batch(config: SyncConfig, rows: DataFrame, name: str, batch: int) -> dict:
    """Check one batch and merge what passes."""
    spark, run_id = rows.sparkSession, f"{name}-{batch}"
    if ORDER not in rows.columns:
        place = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.monotonically_increasing_id().alias("row"))
        rows = rows.withColumn(ORDER, place)
    elif CORRUPT in rows.columns:
        # A broken line has no order of its own; it must not share one with others.
        rows = rows.withColumn(ORDER, F.coalesce(ORDER, -1 - F.monotonically_increasing_id()))
    broken = F.col(CORRUPT).isNotNull() & F.col("account_id").isNull()
    rows = of_accounts(rows, config.accounts).unionByName(rows.filter(broken)) if config.accounts is not None else rows
    folder = run_folder(spark, "stream")
    try:
        checked = stage_checked(prepared(rows.drop("_file", "_block")), registry.schema_for("insights"), path=f"{folder}/checked")
        counts = {r["_ok"]: r["count"] for r in checked.groupBy("_ok").count().collect()}
        if counts.get(False):
            records = checked.filter("NOT _ok").select("record", "issues")
            records.write.mode("overwrite").json(f"{config.quarantine}/run_id={run_id}")
        valid = checked.filter("_ok").select(*registry.schema_for("insights").names)
        merged = versions.upsert(valid, config.path_of(config.table), mark=(name, batch))
    finally:
        remove_folder(spark, folder)
    total = sum(counts.values())
    return {"batch": batch, "total_records": total, "valid_records": counts.get(True, 0), "invalid_records": counts.get(False, 0), **merged}
