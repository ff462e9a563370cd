"""Small text functions: account ids, mapping keys, masking."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

# Prefixes of account ids and of custom conversion action types.
ACCOUNT_PREFIX = "act_"
CUSTOM_PREFIX = "offsite_conversion.custom."


def with_account_prefix(c: Column) -> Column:
    return F.when(c.startswith(ACCOUNT_PREFIX), c).otherwise(F.concat(F.lit(ACCOUNT_PREFIX), c))


def without_account_prefix(c: Column) -> Column:
    return F.replace(c, F.lit(ACCOUNT_PREFIX), F.lit(""))


def mapping_key(account: Column, name: Column) -> Column:
    """Lookup key ``account:name``; a missing part reads ``None``."""
    part = F.lit("None")
    return F.concat(F.coalesce(account, part), F.lit(":"), F.coalesce(name, part))


def day_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def as_day(value: str | date) -> date:
    """A driver-side day argument, given as a date or as ``YYYY-MM-DD``."""
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else datetime.strptime(value, "%Y-%m-%d").date()


def mask_columns(df: DataFrame, tail: tuple[str, ...] = (), full: tuple[str, ...] = ()) -> DataFrame:
    """Hide values: ``tail`` columns keep the last four characters, ``full`` become ``***``.

    Empty and missing values become NULL, so that a mask never looks like a value.
    """
    masked = {}
    for c in (*tail, *full):
        text = F.col(c).cast("string")
        shown = F.right(text, F.lit(4)) if c in tail else F.lit("***")
        masked[c] = F.when(F.length(text) > 0, shown)
    return df.withColumns(masked)
