"""Shape tests and access for VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_ITEMS = "array<struct<action_type string, value variant>>"
_EXACT_ITEMS = "array<struct<action_type variant, value variant>>"
# Non-list JSON texts that count as "nothing there".
_EMPTY_TEXT = r'^(?:null|\{\}|""|false|-?0(?:\.0+)?(?:[eE][+-]?[0-9]+)?)\z'
FRACTION_TYPES = "^(DECIMAL|DOUBLE|FLOAT)"
# Type names reported for JSON values, by the start of Spark's type name.
_TYPE_NAMES = {
    "STRI": "str",
    "BIGI": "int",
    "DECI": "float",
    "DOUB": "float",
    "FLOA": "float",
    "BOOL": "bool",
    "VOID": "NoneType",
    "ARRA": "list",
    "OBJE": "dict",
}


def as_variant(c: Column, data_type: T.DataType) -> Column:
    """A column of any type as VARIANT; text becomes a VARIANT string, not parsed JSON."""
    if isinstance(data_type, T.VariantType):
        return c
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_variant_object(c)
    return c.cast(T.VariantType())


def items_of(v: str) -> str:
    """SQL: the list as ``array<struct<action_type string, value variant>>``; NULL for no list."""
    return f"try_variant_get({v}, '$', '{_ITEMS}')"


def exact_items_of(v: str) -> str:
    """SQL: the list with both members as VARIANT: tells an absent key from a JSON null.

    NULL element: not an object. NULL member: key absent. (A JSON null is a VARIANT null.)
    """
    return f"try_variant_get({v}, '$', '{_EXACT_ITEMS}')"


def is_empty(v: str) -> str:
    """SQL: true for NULL and for scalars or objects that are empty, zero or false."""
    return f"({v} IS NULL OR to_json({v}) RLIKE r'{_EMPTY_TEXT}')"


def lacks_keys(item: str) -> str:
    """SQL: true for an element that is no object or has a NULL member."""
    return f"({item}.action_type IS NULL OR {item}.value IS NULL)"


def is_fraction(v: str) -> str:
    """SQL: true for JSON numbers with a fraction or exponent, or beyond 64 bits."""
    return f"schema_of_variant({v}) RLIKE r'{FRACTION_TYPES}'"


def type_prefix(v: Column) -> Column:
    """The start of the value's type name; cheap to compute per value."""
    return F.coalesce(F.left(F.schema_of_variant(v), F.lit(4)), F.lit("VOID"))


def type_name(prefix: Column) -> Column:
    """Short type name for a ``type_prefix``; SQL NULL is reported like a JSON null."""
    names = F.create_map(*(F.lit(x) for pair in _TYPE_NAMES.items() for x in pair))
    return F.element_at(names, prefix)
