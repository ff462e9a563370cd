"""Text to number and date under strict parsing rules: NULL means "does not parse".

The rules are those of a plain ``float(x)``, ``int(x)`` and ``%Y-%m-%d``. Spark's own
casts are wider (``1d``, ``0x1p3``, ``2024-01``, trailing times), so each cast is
guarded by a pattern. Digits are ASCII only, ``_`` separators and integers beyond 64
bits do not parse.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Blanks allowed around a number, and the accepted spellings. Group 1 is the
# part that is cast.
BLANKS = r"[ \t\n\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*"
INT_PATTERN = rf"^{BLANKS}([+-]?[0-9]+){BLANKS}\z"
FLOAT_PATTERN = (
    rf"^{BLANKS}([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?){BLANKS}\z"
)
SPECIAL_PATTERN = rf"(?i)^{BLANKS}([+-]?(?:inf|infinity|nan)){BLANKS}\z"
DATE_PATTERN = r"^((?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2})\z"
SPACED_DATE_PATTERN = r"^((?!0000)[0-9]{4}-[0-9]{1,2}- [1-9])\z"


def _matched(text: str, pattern: str) -> str:
    """Group 1, or an empty text (which no cast below accepts)."""
    return f"regexp_extract(CAST({text} AS STRING), r'{pattern}', 1)"


def _int(text: str) -> str:
    return f"try_cast({_matched(text, INT_PATTERN)} AS BIGINT)"


def _float(text: str) -> str:
    word = f"lower({_matched(text, SPECIAL_PATTERN)})"
    special = (
        f"CASE WHEN endswith({word}, 'nan') THEN DOUBLE('NaN') "
        f"WHEN startswith({word}, '-') THEN DOUBLE('-Infinity') "
        f"WHEN {word} <> '' THEN DOUBLE('Infinity') END"
    )
    return f"coalesce(try_cast({_matched(text, FLOAT_PATTERN)} AS DOUBLE), {special})"


def _date(text: str) -> str:
    spaced = f"replace({_matched(text, SPACED_DATE_PATTERN)}, ' ', '')"
    return (
        f"coalesce(try_cast({_matched(text, DATE_PATTERN)} AS DATE), try_cast({spaced} AS DATE))"
    )


PARSERS = {"float": _float, "int": _int, "date": _date}


def parse_sql(kind: str, text: str) -> str:
    """SQL that parses the SQL value ``text`` as ``kind``; other kinds are taken as text.

    SQL text, because expressions for all columns are generated: building them from column
    objects takes a call into the JVM per function, seconds for a wide table.
    """
    return PARSERS[kind](text) if kind in PARSERS else f"CAST({text} AS STRING)"


def parse(kind: str, text: str) -> Column:
    """``parse_sql`` as a column; ``text`` is a column name or other SQL."""
    return F.expr(parse_sql(kind, text))
