"""Keep-latest deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from adledger.functions.parsing import parse
from adledger.functions.text import day_text
from adledger.registry import PARTITION

# Key and version column of a daily ad row.
KEYS = ("ad_id", "date_start", "account_id")
LATEST = "date_stop"


def same_key(rows: DataFrame, keys: Sequence[str]) -> list[Column]:
    """What makes rows the same: their keys, a day that parses as that day however it is spelled."""
    out = []
    for k in keys:
        if k == PARTITION and isinstance(rows.schema[k].dataType, T.StringType):
            # A day in the usual form is its own text; only other spellings are parsed.
            usual = F.col(k).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
            other = F.coalesce(day_text(parse("date", k)), F.col(k))
            out.append(F.when(usual, F.col(k)).otherwise(other).alias(k))
        else:
            out.append(F.col(k))
    return out


def keep_latest(
    rows: DataFrame,
    keys: Sequence[str] = KEYS,
    latest: str = LATEST,
    order: str = "_seq",
    alone: Column | None = None,
) -> DataFrame:
    """One row per key: the greatest ``latest``, on ties the first in ingest order.

    Missing keys form a group of their own, and a missing ``latest`` is lowest; a column
    that the rows do not have is missing in all of them. Spark plans ``row_number() = 1``
    with a group limit before the shuffle, so each task sends at most one row per key: a
    key that holds a large share of all rows stays cheap.
    """
    version = F.col(latest) if latest in rows.columns else F.lit("")
    if latest in rows.columns and isinstance(rows.schema[latest].dataType, T.StringType):
        version = F.coalesce(version, F.lit(""))
    same = same_key(rows, [k for k in keys if k in rows.columns])
    if alone is not None:
        # Rows for which this holds have no key of their own; each is kept.
        same.append(F.when(alone, F.col(order)))
    # Columns, as Spark would work out an expression again in every exchange, comparison and window.
    columns = [f"_same_{i}" for i in range(len(same))]
    window = Window.partitionBy(*columns).orderBy(version.desc_nulls_last(), F.col(order).asc())
    ranked = rows.withColumns(dict(zip(columns, same))).withColumn("_rank", F.row_number().over(window))
    return ranked.filter("_rank = 1").drop("_rank", *columns)


def dedup_stats(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows in, rows kept, rows removed; counted from the keys alone."""
    per_key = rows.groupBy(*same_key(rows, keys)).agg(F.count(F.lit(1)).alias("n"))
    n_in, n_out = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return per_key.agg(
        n_in.alias("n_in"), n_out.alias("n_out"), (n_in - n_out).alias("n_removed")
    )


def distinct_keys(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return rows.select(*keys).distinct()
