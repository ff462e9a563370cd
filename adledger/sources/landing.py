"""Landing-zone scans: newline JSON or Parquet of untyped daily rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from datetime import date, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from adledger import registry
from adledger.functions.parsing import parse
from adledger.functions.text import as_day, day_text
from adledger.sources.windows import CHUNK_DAYS, DAYS_BACK, PRESET_DAYS, windows_of_day

CORRUPT = "_corrupt_record"
ORDER = "_seq"


def read_landing(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    schema: T.StructType | None = None,
    accounts: Sequence[str] | None = None,
    since: str | date | None = None,
    until: str | date | None = None,
    skip_files: Sequence[str] = (),
) -> DataFrame:
    """Rows of a landing zone with an ingest-order column ``_seq``.

    ``skip_files`` (see ``unreadable``) are not opened.

    Filters are applied below the order column, so that they still prune the
    ``account_id=…/date_start=…`` folders and reach the file scan. Lines that are not
    JSON come back with ``_corrupt_record`` set (see ``split_corrupt``). ``_seq`` is the
    place of the row: file, block in the file, row in the block. It does not depend on
    how Spark packs files into tasks.
    """
    schema = schema or registry.landing_schema()
    reader = spark.read
    if fmt == "json":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.format(fmt).schema(schema).load(path)
    keep = F.lit(True)
    if skip_files:
        keep = ~F.col("_metadata.file_path").isin(list(skip_files))
    if accounts is not None:
        # The first test reads the account alone, so it can prune account folders. A line that
        # is not JSON may have no account of its own.
        ours = F.col("account_id").isin(list(accounts))
        keep = keep & (ours | F.col("account_id").isNull()) & (ours | _is_corrupt(rows))
    if since is not None and until is not None:
        # Reads the day alone, so it can prune day folders. Only days known to be out of
        # range go; a missing or unparsable one, and with it a line that is not JSON, stays.
        keep = keep & (day_between("date_start", since, until) | day_unknown("date_start"))
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    if ORDER in schema.names:
        return rows.filter(keep)
    return rows.filter(keep).withColumn(ORDER, place)


LEDGER = "path string, length long, modified timestamp, readable boolean, error string"
MOST_UNREADABLE = 10_000


def _fault(path: str, content: bytes) -> str | None:
    """What keeps a file from being read to its end; None if nothing does."""
    try:
        if path.endswith(".gz"):
            unpack = zlib.decompressobj(wbits=31)
            for start in range(0, len(content), 1 << 20):
                part = content[start : start + (1 << 20)]
                while part:  # a file may have several members
                    unpack.decompress(part)
                    part = unpack.unused_data
                    if part:
                        unpack = zlib.decompressobj(wbits=31)
            return None if unpack.eof or not content else "the compressed data end too early"
        if path.endswith(".parquet"):
            for _ in pq.ParquetFile(pa.BufferReader(content)).iter_batches(batch_size=4096):
                pass
    except NotImplementedError:
        return None  # a type that this check does not know
    except Exception as error:
        return f"{type(error).__name__}: {error}"[:500]
    return None


def file_ledger(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """Every file below ``path`` (a row of ``LEDGER``), and whether it can be read to its end.

    Compressed text and Parquet are tried, one file at a time in its task, as a scan that meets a
    broken file stops all accounts, and one that ignores it does not say so. Files that ``known``
    (an earlier ledger) has with the same length and time are not read again. Other files count as
    readable: what is wrong in plain text is wrong in lines.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.col("_metadata.file_path").alias("path")
    listed = files.select(name, "length", F.col("modificationTime").alias("modified"))
    old = spark.createDataFrame([], LEDGER) if known is None else known
    same = ["path", "length", "modified"]
    fresh = files.select(name, "length", F.col("modificationTime").alias("modified"), "content")
    fresh = fresh.where(F.col("path").rlike("[.](gz|parquet)$")).join(old.select(*same), same, "left_anti")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                error = _fault(row.column("path")[0].as_py(), row.column("content")[0].as_py())
                columns = [*(row.column(c) for c in same), pa.array([error is None]), pa.array([error], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*same, "readable", "error"])

    tried = fresh.mapInArrow(probe, LEDGER).unionByName(old)
    found = listed.join(tried, same, "left")
    return found.select(*same, F.coalesce("readable", F.lit(True)).alias("readable"), "error")


def unreadable(ledger: DataFrame) -> list[str]:
    """The files to leave out. More than ``MOST_UNREADABLE`` are an error of the landing zone."""
    paths = [r.path for r in ledger.where("NOT readable").select("path").limit(MOST_UNREADABLE + 1).collect()]
    if len(paths) > MOST_UNREADABLE:
        raise ValueError(f"more than {MOST_UNREADABLE} files cannot be read")
    return sorted(paths)


def _is_corrupt(rows: DataFrame) -> Column:
    """Is the row a line that is not JSON?

    Spark refuses to read a JSON file for this column alone, as a plain count would. The
    second test is never true; it has the scan read one more column.
    """
    if CORRUPT not in rows.columns:
        return F.lit(False)
    return F.col(CORRUPT).isNotNull() | F.coalesce(F.length("ad_id") < 0, F.lit(False))


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Parsed rows, and the lines that are not JSON (None if the source has no such lines)."""
    if CORRUPT not in rows.columns:
        return rows, None
    bad = _is_corrupt(rows)
    return rows.filter(~bad).drop(CORRUPT), rows.filter(bad)


def day_between(column: str, since: str | date, until: str | date) -> Column:
    """``since <= day <= until`` for a day held as text or date.

    Text is compared as a parsed day (``2024-1-5`` is in January). A wider test on the
    text itself goes first: the scan can push it down, the parsed one cannot.
    """
    first, last = as_day(since), as_day(until)
    text = F.col(column).cast("string")
    # "~" sorts after everything a day is spelled with.
    in_years = (text >= f"{first.year:04d}-") & (text <= f"{last.year:04d}-~")
    return in_years & parse("date", column).between(F.lit(first), F.lit(last))


def day_unknown(column: str) -> Column:
    """The day is missing or does not parse, so it is neither in a range nor out of it."""
    return parse("date", column).isNull()


def of_accounts(rows: DataFrame, accounts: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of the given accounts: a list from the caller, or a frame of account ids."""
    if isinstance(accounts, DataFrame):
        return rows.join(accounts.select("account_id").distinct(), "account_id", "left_semi")
    return rows.filter(F.col("account_id").isin(list(accounts)))


def scan_range(
    rows: DataFrame,
    accounts: Sequence[str] | DataFrame,
    since: str | date,
    until: str | date,
    keep_unknown: bool = False,
) -> DataFrame:
    """Rows of the accounts with a day in the range, each once.

    ``keep_unknown`` also keeps rows whose day is missing or does not parse, and lines that are
    not JSON, so that the checks see and count them.
    Deduplicating this gives the same as deduplicating ``scan_windows``, whose extra
    copies of boundary days carry the same order and values.
    """
    keep = day_between("date_start", since, until)
    if keep_unknown:
        keep = (keep | day_unknown("date_start")) if "date_start" in rows.columns else F.lit(True)
    rows = rows.filter(keep)
    if not keep_unknown or CORRUPT not in rows.columns:
        return of_accounts(rows, accounts)
    nobodys = F.col("account_id").isNull() & _is_corrupt(rows)
    if isinstance(accounts, DataFrame):
        ours = accounts.select("account_id", F.lit(True).alias("_ours")).distinct()
        return rows.join(ours, "account_id", "left").filter(F.col("_ours") | nobodys).drop("_ours")
    return rows.filter(F.col("account_id").isin(list(accounts)) | nobodys)


def scan_windows(
    rows: DataFrame,
    accounts: Sequence[str] | DataFrame,
    since: str | date,
    until: str | date,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Rows per extraction window (``since``, ``until`` columns): boundary days come twice.

    The windows of a day follow from its offset in the range, so rows are matched to
    windows in place, with no join and no shuffle.
    """
    hits = windows_of_day(parse("date", "date_start"), since, until, chunk_days)
    return scan_range(rows, accounts, since, until).select("*", F.inline(hits))


def scan_plan(rows: DataFrame, plan: DataFrame, bin_days: int = 8, deal: int = 16) -> DataFrame:
    """Rows per window of any plan (``account_id``, ``since``, ``until``): a row comes once for every
    window of its account that holds its day, with that window.

    An interval join by equal keys: a window is listed under every bin of ``bin_days`` days that it
    touches, a row has the bin of its day, and the exact ends are compared for what meets. Rows of
    an account and bin are dealt to ``deal`` tasks, so that a busy account is split; the plan is
    repeated for that. Rows without a day that parses are in no window. ``since`` and ``until`` of
    the rows, if any, are replaced.
    """
    bin_of = lambda day: F.floor(F.unix_date(day) / F.lit(bin_days))
    wanted = plan.where("since <= until").select("account_id", "since", "until")
    bins = F.explode(F.sequence(bin_of(F.col("since")), bin_of(F.col("until")))).alias("_bin")
    wanted = wanted.select("account_id", "since", "until", bins)
    wanted = wanted.select("*", F.explode(F.sequence(F.lit(0), F.lit(deal - 1))).alias("_deal"))
    found = rows.drop("since", "until").withColumn("_day", parse("date", "date_start"))
    found = found.withColumn("_bin", bin_of(F.col("_day")))
    found = found.withColumn("_deal", F.pmod(F.xxhash64(ORDER), F.lit(deal)).cast("int"))
    joined = found.join(wanted, ["account_id", "_bin", "_deal"]).where("_day BETWEEN since AND until")
    return joined.select(*(c for c in rows.columns if c not in ("since", "until")), "since", "until")


def scan_preset(
    rows: DataFrame,
    accounts: Sequence[str] | DataFrame,
    as_of: str | date,
    days: int = PRESET_DAYS,
    keep_unknown: bool = False,
) -> DataFrame:
    """Rows of the ``days`` whole days before ``as_of``."""
    return scan_range(rows, accounts, *preset(as_of, days), keep_unknown)


def preset(as_of: str | date, days: int = PRESET_DAYS) -> tuple[date, date]:
    """The first and last of the ``days`` whole days before ``as_of``."""
    day = as_day(as_of)
    return day - timedelta(days=days), day - timedelta(days=1)


def look_back(as_of: str | date, days_back: int = DAYS_BACK) -> tuple[date, date]:
    """The range ``[as_of - days_back, as_of]`` of an incremental run."""
    day = as_day(as_of)
    return day - timedelta(days=days_back), day


def project_fields(rows: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """The asked-for fields that the rows have (default: all known), plus ``_seq``."""
    wanted = list(fields) if fields is not None else registry.scan_fields()
    return rows.select(*(c for c in [ORDER, *wanted] if c in rows.columns))


def list_ads(ads: DataFrame, accounts: Sequence[str] | DataFrame) -> DataFrame:
    """Ids of all ads of the accounts, duplicates kept."""
    return of_accounts(ads, accounts).select(F.col("id").alias("ad_id"))


def scan_counts(window_rows: DataFrame) -> DataFrame:
    """Rows scanned per account and window."""
    return window_rows.groupBy("account_id", day_text(F.col("since")).alias("since")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def account_status(rows: DataFrame, accounts: Sequence[str]) -> DataFrame:
    """Per asked-for account: rows read, rows without an ad, corrupt lines, and a status.

    A bad account never stops the others: its corrupt lines are set aside (``corrupt``), and
    an account without any file counts as ``missing``.
    """
    bad = _is_corrupt(rows)
    counts = {
        "n_rows": F.count_if(~bad),
        "n_without_ad": F.count_if(~bad & F.col("ad_id").isNull()),
        "n_corrupt": F.count_if(bad),
    }
    seen = (
        of_accounts(rows, accounts)
        .groupBy("account_id")
        .agg(*(c.alias(name) for name, c in counts.items()))
    )
    wanted = rows.sparkSession.createDataFrame([(a,) for a in accounts], "account_id string")
    status = (
        F.when(F.col("n_rows") + F.col("n_corrupt") == 0, "missing")
        .when(F.col("n_corrupt") > 0, "corrupt")
        .otherwise("ok")
    )
    return (
        wanted.join(seen, "account_id", "left")
        .fillna(0, list(counts))
        .select("account_id", *counts, status.alias("status"))
    )
