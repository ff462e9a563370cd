"""Extraction windows: the plan of overlapping date chunks and the days it covers.

Windows are ``chunk_days`` long and each starts on the last day of the one before, so
boundary days are read twice. Everything is computed per row from the range, so a plan
needs no join: not to combine it with accounts, nor to find the windows of a day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adledger.functions.text import as_day

# Default chunk length and default look-back of a sync, in days.
CHUNK_DAYS = 7
PRESET_DAYS = 30
DAYS_BACK = 7


def _day(value: str | date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(as_day(value))


def _step(chunk_days: int) -> int:
    if chunk_days < 2:
        raise ValueError("chunk_days must be at least 2: windows share their boundary day")
    return chunk_days - 1


def windows(
    since: str | date | Column, until: str | date | Column, chunk_days: int = CHUNK_DAYS
) -> Column:
    """``array<struct<since, until>>`` of a range; empty if the range is empty."""
    step, first, last = _step(chunk_days), _day(since), _day(until)
    starts = F.sequence(first, last, F.make_interval(days=F.lit(step)))
    pairs = F.transform(
        starts,
        lambda s: F.struct(s.alias("since"), F.least(F.date_add(s, step), last).alias("until")),
    )
    return F.coalesce(
        F.when(first <= last, pairs), F.array().cast("array<struct<since:date,until:date>>")
    )


def chunk_plan(
    spark: SparkSession, since: str | date, until: str | date, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """One row per window of a range."""
    return spark.range(1).select(F.inline(windows(since, until, chunk_days)))


def account_plan(
    accounts: DataFrame,
    since: str | date | Column,
    until: str | date | Column,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """One row per account and window; the range may differ by account (columns)."""
    return accounts.select("account_id", F.inline(windows(since, until, chunk_days)))


def windows_of_day(
    day: Column, since: str | date, until: str | date, chunk_days: int = CHUNK_DAYS
) -> Column:
    """The one or two windows that hold ``day``, for a day inside the range."""
    step, first, last = _step(chunk_days), _day(since), _day(until)
    offset = F.datediff(day, first)
    index = F.floor(offset / F.lit(step)).cast("int")

    def window(k: Column) -> Column:
        start = F.date_add(first, k * F.lit(step))
        return F.struct(
            start.alias("since"), F.least(F.date_add(start, step), last).alias("until")
        )

    on_boundary = (offset % F.lit(step) == 0) & (index > 0)
    return F.when(on_boundary, F.array(window(index - 1), window(index))).otherwise(
        F.array(window(index))
    )
