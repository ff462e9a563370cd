"""Inputs of the registered queries, derived from the driver's tables (see FIXTURES.md)."""

from __future__ import annotations

import gzip

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from adledger import registry
from adledger.operators.dedup import keep_latest
from adledger.operators.validate import check, valid_rows

ACCOUNTS = ["900", "901", "902", "903", "904"]
SINCE, UNTIL = "2024-01-01", "2024-01-20"
AS_OF = "2024-01-31"

# Untyped daily rows with planted duplicates, ties, gaps and faults. The text runs in
# Spark and in DuckDB. ``load_no`` tells a morning load from an afternoon load.
ADS_RAW = """
SELECT seq, load_no, event_type, account_id, ad_id, date_start, date_stop, impressions, clicks, spend,
  CASE WHEN seq % 47 = 0 THEN NULL
       WHEN seq % 11 = 0 THEN '[]'
       WHEN seq % 53 = 0 THEN '"oops"'
       WHEN seq % 59 = 0 THEN '[{"value":"1"}]'
       WHEN seq % 61 = 0 THEN '["lead"]'
       ELSE concat('[{"action_type":"', event_type, '","value":"', k, '"},{"action_type":"link_click","value":',
            CASE WHEN seq % 43 = 0 THEN '"3.5"' WHEN seq % 67 = 0 THEN 'null'
                 ELSE concat('"', CAST(seq % 10 AS STRING), '"') END, '}]')
  END AS actions_json
FROM (SELECT event_id AS seq,
    CASE WHEN hour(ts) < 12 THEN 1 ELSE 2 END AS load_no,
    event_type,
    CAST(900 + user_id % 5 AS STRING) AS account_id,
    CAST(user_id AS STRING) AS ad_id,
    CAST(CAST(ts AS DATE) AS STRING) AS date_start,
    CASE WHEN event_id % 23 = 0 THEN NULL
         WHEN event_id % 71 = 0 THEN '2024-02-30'
         ELSE CAST(CAST(CAST(ts AS DATE) + CAST((event_id * 7) % 3 AS INT) AS DATE) AS STRING) END AS date_stop,
    CASE WHEN event_id % 29 = 0 THEN 'n/a' WHEN event_id % 31 = 0 THEN '1.0' WHEN event_id % 37 = 0 THEN NULL
         ELSE CAST(100 + CAST(replace(substr(props, 7), '}', '') AS INT) AS STRING) END AS impressions,
    CAST(CAST(replace(substr(props, 7), '}', '') AS INT) AS STRING) AS clicks,
    CASE WHEN event_id % 41 = 0 THEN 'abc' ELSE CAST(CAST(value AS DECIMAL(12,2)) AS STRING) END AS spend,
    CAST(CAST(replace(substr(props, 7), '}', '') AS INT) AS STRING) AS k
  FROM events) x
"""
RAW_FIELDS = [
    "account_id", "ad_id", "date_start", "date_stop", "impressions", "clicks", "spend",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ads_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter with the action text as VARIANT and ``_seq`` as ingest order."""
    events = table(spark, sf_dir, "events")
    # Braces of the text itself are doubled, because the frame is named in braces.
    text = ADS_RAW.replace("{", "{{").replace("}", "}}")
    rows = spark.sql(text.replace("FROM events", "FROM {events}"), events=events)
    return rows.withColumn("actions", F.try_parse_json("actions_json")).withColumnRenamed(
        "seq", "_seq"
    )


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the columns a landing zone has."""
    return ads_raw(spark, sf_dir).select("_seq", *RAW_FIELDS, "actions")


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing lines of the ``ACCOUNTS`` with planted faults: no day, ``n/a`` for one, cut off."""
    rows = landing_rows(spark, sf_dir).where(F.col("account_id").isin(ACCOUNTS))
    day = F.when(F.expr("_seq % 97 = 0"), None).when(F.expr("_seq % 101 = 0"), "n/a").otherwise(F.col("date_start"))
    line = F.to_json(F.struct(*(day.alias(c) if c == "date_start" else F.col(c) for c in (*RAW_FIELDS, "actions"))))
    cut = F.concat(F.substr(line, F.lit(1), F.lit(20)), F.col("_seq").cast("string"))
    # Files and their lines keep the order of the rows, which breaks ties.
    lines = rows.select("_seq", F.when(F.expr("_seq % 103 = 0"), cut).otherwise(line).alias("value"))
    return lines.repartitionByRange("_seq").sortWithinPartitions("_seq").select("value")


def valid_load(spark: SparkSession, sf_dir: str, load: int | None = None) -> DataFrame:
    """Deduplicated, valid, typed rows in table form: of one load, or of all rows."""
    rows = ads_raw(spark, sf_dir)
    if load is not None:
        rows = rows.filter(F.col("load_no") == load)
    rows = rows.select("_seq", *RAW_FIELDS, "actions")
    return registry.conform(valid_rows(check(keep_latest(rows))))


def write_landing(spark: SparkSession, sf_dir: str, path: str, faults: bool = False, load: int | None = None, packed: bool = False) -> None:
    """A newline-JSON landing zone with a folder per account, or one more load of it.

    With ``faults``, some lines of account 904 are cut off in the middle.
    """
    rows = ads_raw(spark, sf_dir)
    if load is not None:
        rows = rows.filter(F.col("load_no") == load)
    line = F.to_json(F.struct("_seq", *(c for c in RAW_FIELDS if c != "account_id"), "actions"))
    if faults:
        cut = (F.col("account_id") == "904") & (F.col("_seq") % 97 == 0)
        line = F.when(cut, F.substr(line, F.lit(1), F.lit(20))).otherwise(line)
    rows.select("account_id", line.alias("value")).write.mode("append").option("compression", "gzip" if packed else "none").partitionBy("account_id").text(path)


def write_cut_file(spark: SparkSession, path: str, account: str, values: list[str]) -> None:
    """One more compressed file of an account, that ends in the middle."""
    whole = gzip.compress("\n".join(values).encode())
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/account_id={account}/part-cut.txt.gz")
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(whole[: len(whole) // 2])
    out.close()


def landing_schema() -> T.StructType:
    """The landing schema with the ingest order as a data column."""
    return T.StructType(
        [T.StructField("_seq", T.LongType()), *registry.landing_schema().fields]
    )


def raw_records(spark: SparkSession, sf_dir: str, *beside: str) -> DataFrame:
    """Whole records as JSON text, nulls written out; columns ``beside`` them stay columns."""
    record = F.struct(F.col("_seq").alias("seq"), *RAW_FIELDS, "actions")
    return ads_raw(spark, sf_dir).select(
        "_seq", *beside, F.to_json(record, {"ignoreNullFields": "false"}).alias("record")
    )


def conversion_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversion documents as JSON lines: customers of a nation, at most 400 ids apart.

    Every seventh kind of document is cut off, has items without a name, or no data.
    """
    page = F.floor(F.col("c_custkey") / 400)
    nation = F.col("c_nationkey")
    kind = (nation + page) % 7
    account = F.concat(F.when(nation % 2 == 0, "act_").otherwise(""), nation.cast("string"))
    item = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(kind != 6, F.col("c_name")).alias("name"),
        F.lit("PURCHASE").alias("custom_event_type"),
    )
    docs = (
        table(spark, sf_dir, "customer")
        .groupBy(account.alias("account"), page.alias("page"), kind.alias("kind"))
        .agg(F.collect_list(item).alias("data"))
    )
    data = F.when(F.col("kind") != 4, F.col("data")).alias("data")
    line = F.to_json(F.struct("account", data))
    return docs.select(
        F.when(F.col("kind") == 5, F.substr(line, F.lit(1), F.lit(25))).otherwise(line).alias("value")
    )


def standard_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard mappings: each event type but ``error`` for all accounts; two for account 900."""
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()
    name = F.col("event_type")

    def rows(df: DataFrame, prefix: str, account: str) -> DataFrame:
        return df.select(
            name.alias("user_friendly_name"),
            F.concat(F.lit(prefix), name).alias("meta_action_type"),
            F.lit("standard").alias("mapping_type"),
            F.lit(account).alias("ad_account_id"),
        )

    shared = rows(kinds.filter(name != "error"), "any.", "all")
    return shared.unionByName(rows(kinds.filter(name.isin("click", "purchase")), "own.", "900"))
