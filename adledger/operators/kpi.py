"""KPI names: the mapping dimension, its refresh, and lookups against it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from adledger import registry
from adledger.functions.text import mapping_key
from adledger.storage import remove_folder, staged

# Fixed value: the account that stands for all.
ALL_ACCOUNTS = "all"
VERSION = "version"

_LOOKUP = ("ad_account_id", "user_friendly_name", "meta_action_type")


def standard_mappings(spark: SparkSession, rows: Sequence[dict] = ()) -> DataFrame:
    """Mappings given by the caller as a relation; they have no conversion id."""
    columns = [f for f in registry.schema_for("kpi_mapping").fields][:4]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
    return spark.createDataFrame([tuple(r.get(f.name) for f in columns) for r in rows], schema)


def all_mappings(standard: DataFrame, custom: DataFrame | None, run_ts: datetime) -> DataFrame:
    """Both kinds in one relation with an ``origin`` column and one time stamp per run."""
    rows = standard.withColumn("origin", F.lit("standard"))
    if custom is not None:
        rows = rows.unionByName(
            custom.withColumn("origin", F.lit("custom")), allowMissingColumns=True
        )
    if "facebook_conversion_id" not in rows.columns:
        rows = rows.withColumn("facebook_conversion_id", F.lit(None).cast("string"))
    return rows.withColumn("last_updated", F.lit(run_ts).cast("timestamp"))


def origin_counts(mappings: DataFrame) -> DataFrame:
    """One row: standard, custom and total mappings, by where they came from."""
    return mappings.agg(
        F.count_if(F.col("origin") == "standard").alias("standard"),
        F.count_if(F.col("origin") == "custom").alias("custom"),
        F.count(F.lit(1)).alias("total"),
    )


def refresh(standard: DataFrame, custom: DataFrame | None, path: str, run_ts: datetime) -> dict:
    """Replace the mapping table; without any mapping, nothing is written.

    The mappings are staged first, so the documents are read once and a failing input leaves the
    table as it was. Then they are published as a new version, a folder of its own. Readers take
    the latest version, which is there as a whole when its job commits, or not at all. The version
    before it is kept for readers that have begun; older ones are removed.
    """
    spark = standard.sparkSession
    columns = registry.schema_for("kpi_mapping").names
    with staged(all_mappings(standard, custom, run_ts).select(*columns, "origin"), "kpi-refresh") as mappings:
        counts = origin_counts(mappings).first().asDict()
        if not counts["total"]:
            return counts
        known = versions(spark, path)
        version = f"{run_ts:%Y%m%d%H%M%S%f}"
        mappings.select(*columns).write.mode("overwrite").parquet(f"{path}/{VERSION}={version}")
        for old in sorted({*known} - {version})[:-1]:
            remove_folder(spark, f"{path}/{VERSION}={old}")
    return counts


def _all_versions(spark: SparkSession, path: str) -> DataFrame:
    schema = registry.schema_for("kpi_mapping").add(VERSION, "string")
    return spark.read.schema(schema).parquet(path)


def versions(spark: SparkSession, path: str) -> list[str]:
    """The published versions that are still there, the latest last."""
    try:
        rows = _all_versions(spark, path).select(VERSION).distinct().collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r[0] for r in rows)


def read_mappings(spark: SparkSession, path: str) -> DataFrame:
    """The whole mapping table, as of its latest version."""
    every = _all_versions(spark, path)
    latest_version = every.agg(F.max(VERSION)).scalar()
    return every.where(F.col(VERSION) == latest_version).drop(VERSION)


def lookup_columns(spark: SparkSession, path: str) -> DataFrame:
    """The three columns a lookup needs; an absent table reads as empty."""
    try:
        return read_mappings(spark, path).select(*_LOOKUP)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        schema = registry.schema_for("kpi_mapping")
        return spark.createDataFrame([], schema).select(*_LOOKUP)


def summary(mappings: DataFrame) -> DataFrame:
    """Mappings per account and type; rows without either are left out."""
    keys = ["ad_account_id", "mapping_type"]
    return mappings.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def latest(mappings: DataFrame) -> DataFrame:
    """One action type per account and name: the last written one.

    Rows written at the same time are ordered by action type, so the result is stable.
    """
    key = mapping_key(F.col("ad_account_id"), F.col("user_friendly_name"))
    written = F.col("last_updated") if "last_updated" in mappings.columns else F.lit(0)
    order = F.struct(written, F.coalesce("meta_action_type", F.lit("")))
    return mappings.groupBy(key.alias("mapping_key")).agg(
        F.max_by("meta_action_type", order).alias("meta_action_type")
    )


def resolve(
    requests: DataFrame,
    mappings: DataFrame,
    account: str = "ad_account_id",
    name: str = "kpi_name",
) -> DataFrame:
    """Add the action type: the account's own mapping, else the one for all, else NULL.

    A mapping of the account is final even if its action type is NULL. Nothing is hinted:
    adaptive execution sees the real size of the dimension, broadcasts a small one, and splits
    names that most requests ask for when it joins by shuffle.
    """
    table = latest(mappings)
    own, shared = (
        table.select(
            F.col("mapping_key").alias(f"_{n}_key"),
            F.col("meta_action_type").alias(f"_{n}_type"),
        )
        for n in ("own", "all")
    )
    own_key = mapping_key(F.col(account), F.col(name))
    all_key = mapping_key(F.lit(ALL_ACCOUNTS), F.col(name))
    shared = shared.filter(F.col("_all_key").startswith(f"{ALL_ACCOUNTS}:"))
    joined = requests.join(own, own_key == F.col("_own_key"), "left").join(
        shared, all_key == F.col("_all_key"), "left"
    )
    action = F.when(F.col("_own_key").isNotNull(), F.col("_own_type")).otherwise(
        F.col("_all_type")
    )
    return joined.select(*requests.columns, action.alias("meta_action_type"))
