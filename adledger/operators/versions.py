"""A daily table in versions: readers see whole commits, and no update of another writer is lost.

``<path>/data/commit=<id>/date_start=<day>`` holds the files of one commit, which never change.
``<path>/versions/<n>.json`` says which commits hold which day, a line for each such pair. A commit
writes its files, then publishes the next version by a rename that refuses a name that exists. If
another writer was first, the days that both replaced are compared: if there are none, the commit
goes on top of the other one; else it is refused, and ``upsert`` merges again on what is there now.

Versions are small: their lines are bounded by the calendar and by appends of rows without a day.
Files of earlier versions stay, so that their readers can go on.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from adledger import registry
from adledger.operators.upsert import _by_day, _source_facts, merged
from adledger.registry import PARTITION, UPSERT_KEYS
from adledger.storage import remove_folder, staged

UNDATED = "__HIVE_DEFAULT_PARTITION__"  # the folder name of rows without a day


class Conflict(Exception):
    """Another writer has replaced some of the same days since the version that was merged with."""


@dataclass(frozen=True)
class Version:
    """``days``: commits by folder name of the day. ``marks``: the last batch of every stream."""

    number: int = 0
    days: dict[str, tuple[str, ...]] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions that are published, in order."""
    folder, fs = _folder(spark, f"{path}/versions")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def load(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version, by default the latest; number 0 is the empty table."""
    number = (numbers(spark, path) or [0])[-1] if number is None else number
    if not number:
        return Version()
    lines = spark.read.schema("kind string, name string, value string").json(f"{path}/versions/{number}.json")
    days: dict[str, list[str]] = {}
    marks = {}
    for row in lines.collect():
        if row.kind == "mark":
            marks[row.name] = int(row.value)
        else:
            days.setdefault(row.name, []).append(row.value)
    return Version(number, {d: tuple(sorted(c)) for d, c in days.items()}, marks)


def _publish(spark: SparkSession, path: str, version: Version) -> bool:
    """Make a version known under its number; False if another writer has that number."""
    lines = [{"kind": "day", "name": d, "value": c} for d, commits in sorted(version.days.items()) for c in commits]
    lines += [{"kind": "mark", "name": n, "value": str(b)} for n, b in sorted(version.marks.items())]
    draft, fs = _folder(spark, f"{path}/versions/draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write("\n".join(map(json.dumps, lines)).encode())
    out.close()
    final, _ = _folder(spark, f"{path}/versions/{version.number}.json")
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    try:
        none = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), none)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        fs.delete(draft, False)
        return False


def _commit(
    spark: SparkSession, path: str, commit: str, base: Version, replaced: Sequence[str], added: Sequence[str], mark: tuple[str, int] | None
) -> Version:
    """Publish what ``commit`` wrote: days it replaced since ``base``, and days it added rows to."""
    while True:
        last = load(spark, path)
        if mark and last.marks.get(mark[0], -1) >= mark[1]:
            return last
        lost = [d for d in replaced if last.days.get(d) != base.days.get(d)]
        if lost:
            raise Conflict(f"days changed since version {base.number}: {', '.join(lost)}")
        days = {**last.days, **{d: (commit,) for d in replaced}}
        for d in added:
            days[d] = (*days.get(d, ()), commit)
        following = Version(last.number + 1, days, {**last.marks, **(dict([mark]) if mark else {})})
        if _publish(spark, path, following):
            return following


def read(
    spark: SparkSession,
    path: str,
    version: Version | int | None = None,
    schema: T.StructType | None = None,
    days: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of a version (default: the latest), or of some of its days. The files are settled
    here, so later commits do not change what the frame gives."""
    schema = schema or registry.schema_for("insights")
    if not isinstance(version, Version):
        version = load(spark, path, version)
    held = {d: c for d, c in version.days.items() if days is None or d in days}
    folders = [f"{path}/data/commit={c}/{PARTITION}={d}" for d, commits in held.items() for c in commits]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
    return rows.select(*schema.names)


def upsert(
    src: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    keys: Sequence[str] = UPSERT_KEYS,
    retries: int = 3,
    base: Version | None = None,
    mark: tuple[str, int] | None = None,
) -> dict:
    """Merge ``src`` into the versioned table, as ``operators.upsert.upsert`` does.

    The merge starts from ``base`` (default: the latest version). If days were replaced by others in
    the meantime, it is repeated on the latest version, ``retries`` times at most; then ``Conflict``
    is raised and the table is as the others left it. A ``mark`` (stream, batch) makes a replay
    harmless: a batch that the table has is not merged again.
    """
    schema = schema or registry.schema_for("insights")
    spark = src.sparkSession
    with staged(registry.conform(src, schema), "merge-source") as rows:
        processed, days, n_undated = _source_facts(rows, keys)
        if processed == 0:
            return {"processed": 0, "status": "no_records"}
        names = [d.isoformat() for d in days]
        for attempt in range(retries + 1):
            base = base or load(spark, path)
            if mark and base.marks.get(mark[0], -1) >= mark[1]:
                return {"processed": 0, "status": "replayed", "version": base.number}
            commit = uuid.uuid4().hex
            dated = merged(read(spark, path, base, schema, names), rows.filter(F.col(PARTITION).isNotNull()), keys)
            content = dated.unionByName(rows.filter(F.col(PARTITION).isNull()))
            target = f"{path}/data/commit={commit}"
            _by_day(content, len(days) + 1).write.partitionBy(PARTITION).parquet(target)
            try:
                done = _commit(spark, path, commit, base, names, [UNDATED] if n_undated else [], mark)
            except Conflict:
                remove_folder(spark, target)
                if attempt == retries:
                    raise
                base = None
                continue
            return {"processed": processed, "rows_affected": processed, "status": "success", "version": done.number, "attempts": attempt + 1}
