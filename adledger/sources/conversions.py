"""Custom-conversion documents, one JSON object per account and line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adledger.functions.text import CUSTOM_PREFIX, without_account_prefix

_ITEMS = "array<struct<id variant, name variant>>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(account, data)`` rows; ``data`` is VARIANT, and NULL in a line that is not JSON."""
    return (
        spark.read.schema("account string, data variant, _corrupt_record string")
        .option("mode", "PERMISSIVE")
        .json(path)
    )


def _usable(docs: DataFrame) -> tuple[Column, Column]:
    """The items of a document, and whether the document can be used.

    A document without ``data`` has no items. One whose ``data`` is no list of objects,
    or has an item without ``id`` or ``name``, fails as a whole, like a failed account.
    """
    items = F.try_variant_get(F.col("data"), "$", _ITEMS)
    broken = F.exists(items, lambda x: x["id"].isNull() | x["name"].isNull())
    ok = F.col("data").isNull() | (items.isNotNull() & ~broken)
    if "_corrupt_record" in docs.columns:
        ok = ok & F.col("_corrupt_record").isNull()
    return items, ok


def custom_mappings(docs: DataFrame) -> DataFrame:
    """One mapping row per item of every usable document."""
    items, ok = _usable(docs)
    rows = docs.select("account", items.alias("items"), ok.alias("ok")).filter("ok")
    item_id = F.col("item.id").cast("string")
    return rows.select("account", F.explode("items").alias("item")).select(
        F.col("item.name").cast("string").alias("user_friendly_name"),
        F.concat(F.lit(CUSTOM_PREFIX), item_id).alias("meta_action_type"),
        F.lit("custom").alias("mapping_type"),
        without_account_prefix(F.col("account")).alias("ad_account_id"),
        item_id.alias("facebook_conversion_id"),
    )


def failed_documents(docs: DataFrame) -> DataFrame:
    """The documents that ``custom_mappings`` leaves out."""
    _, ok = _usable(docs)
    return docs.filter(~ok)
