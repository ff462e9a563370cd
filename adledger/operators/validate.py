"""Checks and casts of untyped rows, generated from the column registry.

``check`` adds hidden columns and reads each value once; the other functions select
from its result. Everything is built-in expressions, and there is no shuffle.

Two stages, as a row meets them: *checks* collect every issue (scalars must parse, lists
must hold objects with both keys), then the *cast* also needs the nested values to parse.
A row whose checks pass and whose cast fails has the one issue ``transformation_failed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adledger import registry
from adledger.functions.parsing import PARSERS, parse_sql
from adledger.functions.variants import (
    FRACTION_TYPES,
    as_variant,
    exact_items_of,
    is_empty,
    is_fraction,
    items_of,
    lacks_keys,
)
from adledger.storage import stage

# Issue codes.
BAD_VALUE = "bad_value"
NOT_LIST = "not_list"
NOT_OBJECT = "not_object"
MISSING_KEYS = "missing_keys"
CAST_FAILED = "transformation_failed"
NOT_JSON = "not_json"
REQUIRED = "required"

ISSUES = "array<struct<code:string,field:string,idx:int,value:string>>"
_HIDDEN = ("_issues", "_bad", "_ok")
LINE = "_corrupt_record"  # holds a landing line that is not JSON


def check(
    rows: DataFrame,
    name: str = "insights",
    enforce_required: bool = False,
    order: str = "_seq",
) -> DataFrame:
    """Add ``_issues``, ``_bad`` (a check failed), ``_ok`` (usable) and ``_typed_*``."""
    present = [f for f in registry.fields(name) if f.name in rows.columns]
    parsed = [f for f in present if not f.nested and f.kind in PARSERS]
    nested = [f for f in present if f.nested]
    required = [f for f in present if enforce_required and not f.nullable]

    # Parse once. A later projection refers to these columns several times.
    types = {f.name: rows.schema[f.name].dataType for f in nested}
    out = rows.withColumns(
        {f"_variant_{f.name}": as_variant(F.col(f.name), types[f.name]) for f in nested}
    )
    out = _with_sql(
        out,
        {
            **{f"_typed_{f.name}": parse_sql(f.kind, f"`{f.name}`") for f in present if not f.nested},
            **{f"_items_{f.name}": items_of(f"_variant_{f.name}") for f in nested},
        },
    )
    bad = _any(
        [_unparsed(f) for f in parsed]
        + [f"`{f.name}` IS NULL" for f in required]
        + [_malformed(f) for f in nested]
    )
    # A filter on the verdict must not be pushed below this projection: it would be
    # evaluated there from the raw columns, parsing everything again. Optimizer rules leave
    # an expression alone that is not deterministic, and this one is always true.
    pinned = "monotonically_increasing_id() >= 0"
    out = _with_sql(
        out,
        {f"_typed_{f.name}": _typed_items(f) for f in nested} | {"_bad": f"{bad} AND {pinned}"},
    )
    data = [c for c in rows.columns if c != order]
    blank = "NOT " + _any([f"`{c}` IS NOT NULL" for c in data])
    out = _with_sql(out, {"_failed": _any([_lost_values(f) for f in nested] + [blank])})
    # The issue list is only built for rows that have issues.
    scalar_issues = [
        *(_when(_unparsed(f), _issue(BAD_VALUE, f, value=f"`{f.name}`")) for f in parsed),
        *(_when(f"`{f.name}` IS NULL", _issue(REQUIRED, f)) for f in required),
    ]
    lists = [_issue_list(scalar_issues), *(_nested_issues(f) for f in nested)]
    all_issues = f"filter(concat({', '.join(lists)}), x -> x IS NOT NULL)"
    out = _with_sql(
        out,
        {
            "_ok": "NOT _bad AND NOT _failed",
            "_issues": f"CASE WHEN _bad THEN {all_issues} "
            f"WHEN _failed THEN {_issue_list([_issue(CAST_FAILED)])} ELSE {_issue_list([])} END",
        },
    )
    helpers = [c for f in nested for c in (f"_variant_{f.name}", f"_items_{f.name}")]
    return out.drop(*helpers, "_failed")


def _with_sql(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(sql) for name, sql in columns.items()})


def _any(conditions: list[str]) -> str:
    return "(" + " OR ".join(f"({c})" for c in conditions or ["false"]) + ")"


def _when(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


def _issue(
    code: str, field: registry.Field | None = None, idx: str = "NULL", value: str = "NULL"
) -> str:
    name = f"'{field.name}'" if field else "CAST(NULL AS STRING)"
    return (
        f"named_struct('code', '{code}', 'field', {name}, "
        f"'idx', CAST({idx} AS INT), 'value', CAST({value} AS STRING))"
    )


def _issue_list(issues: list[str]) -> str:
    return f"CAST(array({', '.join(issues)}) AS {ISSUES})"


def _unparsed(f: registry.Field) -> str:
    return f"`{f.name}` IS NOT NULL AND _typed_{f.name} IS NULL"


def _malformed(f: registry.Field) -> str:
    """True if the value is no list, or an element is no object or lacks a key.

    An element without any NULL is fine. Otherwise the key may be absent or a JSON null,
    and the value itself is asked again.
    """
    items, whole = f"_items_{f.name}", f"_variant_{f.name}"
    return (
        f"CASE WHEN {items} IS NULL THEN NOT {is_empty(whole)} "
        f"WHEN exists({items}, i -> {lacks_keys('i')}) "
        f"THEN exists({exact_items_of(whole)}, i -> {lacks_keys('i')}) ELSE false END"
    )


def _nested_issues(f: registry.Field) -> str:
    whole = f"_variant_{f.name}"
    raw = f"to_json(try_variant_get({whole}, '$', 'array<variant>')[n])"
    per_item = (
        f"transform({exact_items_of(whole)}, (i, n) -> "
        f"CASE WHEN i IS NULL THEN {_issue(NOT_OBJECT, f, 'n', raw)} "
        f"WHEN {lacks_keys('i')} THEN {_issue(MISSING_KEYS, f, 'n', raw)} END)"
    )
    return (
        f"CASE WHEN _items_{f.name} IS NOT NULL THEN CAST({per_item} AS {ISSUES}) "
        f"WHEN NOT {is_empty(whole)} "
        f"THEN {_issue_list([_issue(NOT_LIST, f, value=f'to_json({whole})')])} "
        f"ELSE {_issue_list([])} END"
    )


def _typed_items(f: registry.Field) -> str:
    """Typed list with the two known keys; an empty list and a non-list become NULL.

    Integers do not come from ``3.0`` or ``1e3``.
    """
    value = parse_sql(f.kind, "try_cast(i.value AS STRING)")
    if f.kind == "int":
        value = _when(f"NOT {is_fraction('i.value')}", value)
    typed = f"named_struct('action_type', i.action_type, 'value', {value})"
    return _when(f"size(_items_{f.name}) > 0", f"transform(_items_{f.name}, i -> {typed})")


def _lost_values(f: registry.Field) -> str:
    """True if a nested value is there but did not parse (or is null where it must not be)."""
    items, typed = f"_items_{f.name}", f"_typed_{f.name}"
    absent = "is_variant_null(i.value)" if f.nullable else "false"
    lost = f"exists(zip_with({items}, {typed}, (i, t) -> t.value IS NULL AND NOT {absent}), x -> x)"
    return f"CASE WHEN exists({typed}, t -> t.value IS NULL) THEN {lost} ELSE false END"


def reject_lines(checked: DataFrame, line: str) -> DataFrame:
    """Rows whose ``line`` is set are landing lines that are not JSON: that is their one issue."""
    broken = F.col(line).isNotNull()
    return checked.withColumns(
        {
            "_ok": F.col("_ok") & ~broken,
            "_bad": F.col("_bad") | broken,
            "_issues": F.when(broken, F.expr(_issue_list([_issue(NOT_JSON)]))).otherwise(F.col("_issues")),
        }
    )


def _data_columns(checked: DataFrame) -> list[str]:
    return [c for c in checked.columns if c not in _HIDDEN and c != LINE and not c.startswith("_typed_")]


def typed_columns(checked: DataFrame) -> list[Column]:
    """The row's columns with registered ones cast; unknown ones as they came."""
    return [
        F.col(f"_typed_{c}" if f"_typed_{c}" in checked.columns else c).alias(c)
        for c in _data_columns(checked)
    ]


def valid_rows(checked: DataFrame) -> DataFrame:
    """Cast rows that passed."""
    return checked.filter("_ok").select(*typed_columns(checked))


def record_json(checked: DataFrame) -> Column:
    """The landing row as JSON text, without absent values; a line that is not JSON as it is."""
    record = F.to_json(F.struct(*_data_columns(checked)))
    return F.coalesce(F.col(LINE), record) if LINE in checked.columns else record


def invalid_rows(checked: DataFrame, keep: tuple[str, ...] = ("_seq",)) -> DataFrame:
    """``record`` (the landing row as JSON) and ``issues`` of the rows that did not pass."""
    return checked.filter("NOT _ok").select(
        *keep, record_json(checked).alias("record"), F.col("_issues").alias("issues")
    )


def issue_rows(checked: DataFrame, keep: tuple[str, ...] = ("_seq",)) -> DataFrame:
    """One row per issue found by the checks (a failed cast is no check)."""
    return checked.filter("_bad").select(*keep, F.inline("_issues"))


def until_first_error(checked: DataFrame, order: str = "_seq") -> DataFrame:
    """Rows up to and including the first that fails a check; a failed cast does not cut.

    The checked rows are stored once, so that the place of the cut and the rows before it come from
    one evaluation; blocks behind the cut are not read where ``order`` is a number.
    """
    checked = stage(checked, "first-error")
    first_bad = checked.filter("_bad").agg(F.min(order)).scalar()
    return checked.filter((F.col(order) <= first_bad) | first_bad.isNull())


def verdict_counts(checked: DataFrame) -> DataFrame:
    """One row: total, valid and invalid rows."""
    return checked.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("_ok")).alias("valid_records"),
        F.count_if(~F.col("_ok")).alias("invalid_records"),
    )


def value_conforms(field: registry.Field, v: Column) -> Column:
    """Does a VARIANT value have the field's JSON type? (No parsing: ``"7"`` is no int.)"""
    shape = F.schema_of_variant(v)
    if field.kind == "date":
        fits = shape == "STRING"
    elif field.nested:
        fits = shape.startswith("ARRAY")
    elif field.kind == "str":
        fits = shape == "STRING"
    elif field.kind == "int":
        fits = shape.isin("BIGINT", "BOOLEAN")
    else:
        fits = shape.rlike(FRACTION_TYPES)
    return F.when(v.isNull() | F.is_variant_null(v), F.lit(field.nullable)).otherwise(fits)
