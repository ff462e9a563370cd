"""Exact deduplication as a stateful stream, in DataFrame operations only.

1. Every row *arrives* as a digest of its normalised text, its id, its length in code points and
   a content locator (file and id). Arrivals are written to the shared folder once.
2. A stream reads the arrivals. Its keyed state never expires and lives in RocksDB, on disk, with
   its checkpoints in the shared folder. Per digest it keeps the number of rows, and the row to
   keep with its locator. Spark combines a digest's rows before the shuffle, so that a text with
   any number of copies is one row per task and batch.
3. Rows that *hit* a digest someone else has are checked byte for byte: the content behind the
   locator of the kept row is fetched and compared with theirs, by way of the least and greatest
   content of a digest, which tasks find before the shuffle. Other rows are not compared.
4. If a comparison ever fails, all rows of that digest are grouped by their normalised texts
   instead, so a collision changes nothing in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adledger.storage import run_folder, stage

# Keyed state on disk. A store is closed when its batch is committed to the shared folder; open,
# each takes 4 MB of an executor's disk in advance, however little it holds.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
_STATE = "digest string, group_size long, best struct<points:long,neg_id:long,file:string>"


def normalised(text: Column) -> Column:
    """The text without its ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]", "")


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _arrivals(docs: DataFrame, digest) -> DataFrame:
    return docs.select(
        "doc_id",
        sha256_of(normalised(F.col("text"))).alias("text_sha256"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("points"),
        F.input_file_name().alias("file"),
    ).withColumn("digest", digest(F.col("text_sha256")))


def watch(arrivals: DataFrame, state: str, updates: str):
    """Feed a stream of arrivals to the keyed state; changed keys go to ``updates`` by batch.

    Returns the running query. Start it again with the same folders to go on where it ended:
    the state knows all earlier batches.
    """
    spark = arrivals.sparkSession
    groups = arrivals.groupBy("digest").agg(
        F.count("*").alias("group_size"),
        F.max(F.struct("points", (-F.col("doc_id")).alias("neg_id"), "file")).alias("best"),
    )

    def publish(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{updates}/batch={batch}")

    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        return (
            groups.writeStream.outputMode("update")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .foreachBatch(publish)
            .start()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def latest(spark: SparkSession, updates: str) -> DataFrame:
    """One row per digest: what the state holds after the last batch."""
    changes = spark.read.schema(f"{_STATE}, batch long").parquet(updates)
    newest = F.max_by(F.struct("group_size", "best"), "batch").alias("s")
    return changes.groupBy("digest").agg(newest).select("digest", "s.group_size", "s.best")


def exact_dedup(docs: DataFrame, digest=lambda sha256: sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs``.

    Texts are equal when they are after ``normalised``. Of equal texts, the row with the most code
    points, then with the smallest ``doc_id`` is kept. Rows that share a ``doc_id`` count on their
    own in ``group_size``; ``kept`` compares ids. A null ``doc_id`` comes after all others. Columns
    other than ``doc_id`` and ``text`` are not read. An empty table gives no rows.

    ``digest`` may shorten the SHA-256 that keys the state; results do not depend on it.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "exact-dedup")
    arrivals = stage(_arrivals(docs, digest), "arrivals", path=f"{folder}/arrivals")
    # The state may have nothing to report; its folder exists all the same.
    spark.createDataFrame([], _STATE).write.parquet(f"{folder}/updates/batch=-1")
    stream = spark.readStream.schema(arrivals.schema).parquet(f"{folder}/arrivals")
    watch(stream, f"{folder}/state", f"{folder}/updates").awaitTermination()
    groups = stage(latest(spark, f"{folder}/updates"), "groups", path=f"{folder}/groups")

    hits = stage(_hits(docs, groups, digest), "hits", path=f"{folder}/hits")
    split = stage(_collisions(hits), "collisions", path=f"{folder}/collisions")
    result = _labelled(arrivals.join(groups, "digest"))
    if split.isEmpty():
        return result
    whole = arrivals.join(split, "digest", "left_anti").join(groups, "digest")
    return _labelled(whole).unionByName(_labelled(_by_content(hits.join(split, "digest", "left_semi"))))


def _hits(docs: DataFrame, groups: DataFrame, digest) -> DataFrame:
    """The rows whose digest others have, too, with their content and the kept row's locator."""
    content = normalised(F.col("text"))
    rows = docs.select(
        "doc_id",
        content.alias("content"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("points"),
        F.input_file_name().alias("file"),
        digest(sha256_of(content)).alias("digest"),
    )
    return rows.join(groups.where("group_size > 1").select("digest", "best"), "digest")


def _collisions(hits: DataFrame) -> DataFrame:
    """Digests with rows whose content differs from that of the kept row, byte by byte.

    The least and the greatest content of a digest are compared with what the locator holds. Tasks
    reduce their rows to these three before the shuffle, so that no digest is large.
    """
    at_locator = F.struct("points", (-F.col("doc_id")).alias("neg_id"), "file").eqNullSafe(F.col("best"))
    ends = hits.groupBy("digest").agg(
        F.min("content").alias("least"),
        F.max("content").alias("greatest"),
        F.max(F.when(at_locator, F.col("content"))).alias("held"),
    )
    return ends.where("least != held or greatest != held").select("digest")


def _by_content(hits: DataFrame) -> DataFrame:
    """Groups by the content itself, for digests that stand for several."""
    rows = hits.select("doc_id", "content", "points", sha256_of(F.col("content")).alias("text_sha256"))
    best = F.max(F.struct("points", (-F.col("doc_id")).alias("neg_id"))).alias("best")
    groups = rows.groupBy("content").agg(F.count("*").alias("group_size"), best)
    return rows.join(groups, "content")


def _labelled(rows: DataFrame) -> DataFrame:
    keep_id = -F.col("best.neg_id")
    return rows.select(
        "doc_id",
        keep_id.alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )
