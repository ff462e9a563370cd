"""Schema drift: what the files of a live table hold, against the columns it should have.

A table lives longer than its schema. Columns that files lack read as null (``add``), narrower numbers
are widened where no value can change (``widen``), unknown columns stay unread (``extra``), and all
else is refused by name before a row is read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, types as T

from adledger import registry
from adledger.registry import PARTITION

# Changes of type that keep every value.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}
_WRITE = re.compile(r"part-\d+-([0-9a-f-]{36})[^/]*$")


class Drifted(ValueError):
    """Files hold columns that cannot be read as the table's."""


@dataclass(frozen=True)
class Change:
    """``action``: same, add, widen, extra or refuse. Parts of nested columns have dotted names."""

    column: str
    found: str | None
    wanted: str | None
    action: str


@dataclass(frozen=True)
class Age:
    """Files that one schema describes, without the partition column."""

    files: tuple[str, ...]
    schema: T.StructType


def _record(kind: T.DataType) -> T.StructType | None:
    """The fields inside a struct or a list of structs."""
    inner = kind.elementType if isinstance(kind, T.ArrayType) else kind
    return inner if isinstance(inner, T.StructType) else None


def compare(found: T.StructType, wanted: T.StructType, within: str = "") -> list[Change]:
    """The change of every column, in the order of ``wanted``, then the extra ones."""
    changes = []
    known = {f.name: f.dataType for f in found.fields}
    for f in wanted.fields:
        column, old = within + f.name, known.get(f.name)
        names = old.simpleString() if old is not None else None, f.dataType.simpleString()
        inner = _record(old), _record(f.dataType)
        if old is None:
            changes.append(Change(column, *names, "add"))
        elif names[0] == names[1]:
            changes.append(Change(column, *names, "same"))
        elif all(inner) and isinstance(old, T.ArrayType) == isinstance(f.dataType, T.ArrayType):
            changes += compare(*inner, f"{column}.")
        else:
            action = "widen" if names[1] in WIDER.get(names[0], ()) else "refuse"
            changes.append(Change(column, *names, action))
    for f in found.fields:
        if f.name not in wanted.names:
            changes.append(Change(within + f.name, f.dataType.simpleString(), None, "extra"))
    return changes


def _merged_schema(spark: SparkSession, path: str, files: list[str]) -> T.StructType | None:
    """The one schema of the files, read in a job of their footers; None if there is no such."""
    try:
        return spark.read.option("mergeSchema", True).option("basePath", path).parquet(*files).schema
    except Py4JJavaError as error:
        if "[CANNOT_MERGE_SCHEMAS]" not in str(error.java_exception):
            raise
        return None


def ages(spark: SparkSession, path: str) -> list[Age]:
    """The files of a table by the schema that they were written with.

    Files of one write bear its id in their names and have one schema, so one of them stands for
    all. Writes whose schemas merge are one age; others are halved until they do.
    """
    writes: dict[str, list[str]] = {}
    for file in sorted(spark.read.schema("_none int").parquet(path).inputFiles()):
        write = _WRITE.search(file)
        writes.setdefault(write.group(1) if write else file, []).append(file)
    found: dict[str, tuple[T.StructType, list[str]]] = {}
    open_ = [list(writes.values())] if writes else []
    while open_:
        group = open_.pop()
        schema = _merged_schema(spark, path, [files[0] for files in group])
        if schema is None:
            open_ += [group[: len(group) // 2], group[len(group) // 2 :]]
            continue
        schema = T.StructType([f for f in schema.fields if f.name != PARTITION])
        files = found.setdefault(schema.simpleString(), (schema, []))[1]
        files += [f for write in group for f in write]
    return [Age(tuple(files), schema) for schema, files in found.values()]


def _stored(wanted: T.StructType) -> T.StructType:
    return T.StructType([f for f in wanted.fields if f.name != PARTITION])


def drift(spark: SparkSession, path: str, wanted: T.StructType | None = None) -> DataFrame:
    """One row per age and column that is not the same: column, found, wanted, action, n_files."""
    wanted = _stored(wanted or registry.schema_for("insights"))
    rows = [
        (c.column, c.found, c.wanted, c.action, len(age.files))
        for age in ages(spark, path)
        for c in compare(age.schema, wanted)
        if c.action != "same"
    ]
    return spark.createDataFrame(rows, "column string, found string, wanted string, action string, n_files long")


def _cast(value: str, found: T.DataType, wanted: T.DataType) -> str:
    """A value in its wanted type; fields of structs are matched by name, not by place."""
    if found.simpleString() == wanted.simpleString():
        return value
    if _record(wanted) is None:
        return f"CAST({value} AS {wanted.simpleString()})"
    known = {f.name: f.dataType for f in _record(found).fields}
    item = "x" if isinstance(wanted, T.ArrayType) else value
    parts = ", ".join(
        f"'{f.name}', "
        + (_cast(f"{item}.`{f.name}`", known[f.name], f.dataType) if f.name in known else f"CAST(NULL AS {f.dataType.simpleString()})")
        for f in _record(wanted).fields
    )
    built = f"IF({item} IS NULL, NULL, named_struct({parts}))"
    return f"transform({value}, x -> {built})" if isinstance(wanted, T.ArrayType) else built


def read_any_age(spark: SparkSession, path: str, wanted: T.StructType | None = None) -> DataFrame:
    """The table in its wanted columns, whatever the age of its files.

    Every age is a scan of its own, so that filters and columns are pushed down to each. Raises
    ``Drifted``, with the columns, if any file holds one that cannot be read without a loss.
    """
    wanted = wanted or registry.schema_for("insights")
    found = ages(spark, path)
    refused = sorted(
        {f"{c.column} ({c.found} for {c.wanted})" for a in found for c in compare(a.schema, _stored(wanted)) if c.action == "refuse"}
    )
    if refused:
        raise Drifted(f"files of {path} do not fit: {', '.join(refused)}")
    out = spark.createDataFrame([], wanted)
    for age in found:
        parts = [f for f in wanted.fields if f.name == PARTITION]
        rows = spark.read.schema(T.StructType([*age.schema.fields, *parts])).option("basePath", path).parquet(*age.files)
        known = {f.name: f.dataType for f in rows.schema.fields}
        out = out.unionByName(
            rows.selectExpr(
                *(
                    (_cast(f"`{f.name}`", known[f.name], f.dataType) if f.name in known else f"CAST(NULL AS {f.dataType.simpleString()})")
                    + f" AS `{f.name}`"
                    for f in wanted.fields
                )
            )
        )
    return out
