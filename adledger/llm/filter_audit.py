"""What document filters remove, in every order of applying them, from retracting streams.

1. Every document *arrives* as its part, the mask of the text filters it fails, a digest of its text
   and its labels. Arrivals are written to the shared folder.
2. A stream reads all arrival files as available-now micro-batches. A text with a smaller id than
   this one in another document makes this one fail the last filter (``E``). Tasks first combine
   their rows: only the documents with a task's smallest id of a text have a chance to pass, the
   others are counted as failing at once. Keyed state keeps every text's smallest id so far and
   what was counted as passing for it. When a smaller id arrives, that is retracted: minus one at the
   earlier mask, plus one at the mask with ``E``. What leaves a batch are changes of part counters.
   A key of the state is a bucket of about ``BUCKET`` texts by hash, as the cost of a Python call per
   key is that of hundreds of texts; the number of buckets grows with the documents.
3. The counters, one per part and mask, hold all that the orders need: a filter removes the documents
   whose mask has its bit and none of a filter before it.

A text with any number of copies reaches its bucket as a few rows per task. A replayed batch
overwrites its own changes. Counters are bounded by parts and masks, not by documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from adledger.llm.exact_dedup import STATE_SETTINGS
from adledger.storage import remove_folder, run_folder, stage

FILTERS = "ABCDE"  # the last one is that of repeated texts
REPEATED = 1 << 4
BATCHES = 4  # micro-batches that the arrivals are dealt to, about
BUCKET = 2_000  # texts of a key of the state, about

_ORDERS = ",".join("".join(p) for p in permutations(FILTERS))
COUNTED = ["part", "mask", "good", "toxic"]
_ROW = ["digest", "id", *COUNTED]
_CHANGES = "part string, mask int, good int, toxic int, n long"
_COMBINED = f"digest binary, id long, {_CHANGES}"
_SCHEMA = pa.schema(
    [("digest", pa.binary()), ("id", pa.int64()), ("part", pa.string())]
    + [(c, pa.int32()) for c in ("mask", "good", "toxic")]
    + [("n", pa.int64())]
)


def failures(text: Column) -> Column:
    """The mask of filters A to D that a text fails: bit 0 for A.

    A: under 200 words; B: fewer than half of the words are distinct; C: more than 2 % of the code
    points are capitals A-Z; D: one of ``#$%&*|`` occurs. Words are parted by ASCII white space.
    """
    # The first and last word may be empty, as where the text begins or ends with white space.
    words = F.split(text, r"[\x20\x09-\x0D]+")
    empty = (F.element_at(words, 1) == "").cast("int") + ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int")
    distinct = F.size(F.array_distinct(words)) - (empty > 0).cast("int")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    count = F.size(words) - empty
    checks = [count < 200, 100 * distinct < 50 * count, 100 * capitals > 2 * F.char_length(text), text.rlike("[#$%&*|]")]
    return sum((c.cast("int") * F.lit(1 << i) for i, c in enumerate(checks)), F.lit(0))


def arrivals_of(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(id, part, digest, mask, good, toxic) of every document."""
    known = labels.where("doc_id is not null").groupBy("doc_id")
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        failures(text).alias("mask"),
    )
    joined = rows.join(known, rows["id"] == known["doc_id"], "left")
    flag = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return joined.select("id", "part", "digest", "mask", flag("good"), flag("toxic"))


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the least id of their text here, equal ones as one; the rest is counted as failing,
    under no text and no id. A row without an id passes for good."""
    for batch in batches:
        rows = batch.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        rows["n"] = 1
        first = rows.groupby("digest")["id"].transform("min")
        later = (rows["id"] > first).fillna(False).astype(bool)
        settled = later | rows["id"].isna()
        rows.loc[later, "mask"] |= REPEATED
        rows.loc[settled, "digest"] = None
        rows.loc[settled, "id"] = None
        rows = rows.groupby(_ROW, dropna=False, as_index=False)["n"].sum()
        rows["id"] = rows["id"].astype("Int64")
        yield pa.RecordBatch.from_pandas(rows[[*_ROW, "n"]], _SCHEMA, preserve_index=False)


def _update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the part counters by new rows of a bucket's texts.

    The state is a table of every text's least id so far and its rows, which count as passing.
    """
    held = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else None
    changes = []
    for rows in batches:
        settled = rows["id"].isna()
        changes.append(rows.loc[settled, [*COUNTED, "n"]])
        rows = rows[~settled].astype({"id": "int64"})
        rows["new"] = True
        if held is not None:
            rows = pd.concat([rows, held.assign(new=False)], ignore_index=True)
        passes = rows["id"] == rows.groupby("digest")["id"].transform("min")
        changes.append(rows.loc[rows["new"] & passes, [*COUNTED, "n"]])
        fails = rows.loc[~passes, [*COUNTED, "n", "new"]]
        # What was counted as passing until now is retracted.
        changes.append(fails.loc[~fails["new"], [*COUNTED, "n"]].assign(n=lambda r: -r["n"]))
        changes.append(fails.assign(mask=fails["mask"] | REPEATED)[[*COUNTED, "n"]])
        held = rows[passes].groupby(_ROW, as_index=False)["n"].sum()
    if held is not None and len(held):
        table = pa.Table.from_pandas(held, _SCHEMA, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        state.update((sink.getvalue().to_pybytes(),))
    yield pd.concat(changes, ignore_index=True).groupby(COUNTED, as_index=False)["n"].sum()


def watch(arrivals: DataFrame, state: str, changes: str, buckets: int):
    """Feed a stream of arrivals to the keyed state; changes of counters go to ``changes`` by batch.

    Returns the running query. Started again with the same folders and as many ``buckets`` it goes
    on where it ended, with all earlier texts known.
    """
    spark = arrivals.sparkSession
    combined = arrivals.select(*_ROW).mapInArrow(_combine, _COMBINED)
    bucket = F.pmod(F.xxhash64(F.coalesce("digest", F.col("part").cast("binary"))), F.lit(buckets)).alias("bucket")
    changed = combined.select("*", bucket).groupBy("bucket").applyInPandasWithState(
        _update, _CHANGES, "texts binary", "update", GroupStateTimeout.NoTimeout
    )

    def publish(batch_rows: DataFrame, batch: int) -> None:
        batch_rows.groupBy(*COUNTED).agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{changes}/batch={batch}")

    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        writer = changed.writeStream.outputMode("update").option("checkpointLocation", state)
        return writer.trigger(availableNow=True).foreachBatch(publish).start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def counters(docs: DataFrame, labels: DataFrame, part: str = "source", batches: int = BATCHES) -> DataFrame:
    """(part, mask, good, toxic, n): documents by part, failed filters and labels.

    ``docs`` has doc_id, text and ``part``; ``labels`` doc_id, quality and toxic. A null text counts
    as empty, a null part as the empty string. Text is repeated if a smaller id has the same; rows
    with equal ids and texts are not smaller than each other, and a null id neither is smaller nor
    has a smaller one. Repeated labels of an id count as 1 if one of them is. An empty table gives
    no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "filter-audit")
    arrivals = stage(arrivals_of(docs, labels, part), "arrivals", path=f"{folder}/arrivals")
    empty = spark.createDataFrame([], _CHANGES)
    empty.write.parquet(f"{folder}/changes/batch=-1")
    files = max(1, -(-len(arrivals.inputFiles()) // batches))
    stream = spark.readStream.schema(arrivals.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/arrivals")
    watch(stream, f"{folder}/state", f"{folder}/changes", max(1, arrivals.count() // BUCKET)).awaitTermination()
    changes = spark.read.schema(f"{_CHANGES}, batch long").parquet(f"{folder}/changes")
    total = changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")
    result = stage(total, "filter-counters")
    remove_folder(spark, folder)
    return result


def effects(counts: DataFrame) -> DataFrame:
    """What every filter does in every order and part, from ``counters``.

    A row per part, order of the filters and step. A part's masks meet in one row, 32 at most with
    their sums, before the orders are laid out; parts stay distributed.
    """
    passed = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(f"{c}_n")
    sums = counts.groupBy("part", "mask").agg(F.sum("n").alias("n"), passed("good"), passed("toxic"))
    parts = sums.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good_n", "toxic_n")).alias("masks"))
    order = F.explode(F.split(F.lit(_ORDERS), ",")).alias("filter_order")
    steps = parts.select("part", "masks", order).select("*", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("step"))
    bits = F.expr("transform(split(filter_order, ''), f -> shiftleft(1, ascii(f) - ascii('A')))")
    below = F.aggregate(F.slice("bits", F.lit(1), F.col("step") - 1), F.lit(0), lambda a, b: a.bitwiseOR(b))
    steps = steps.withColumn("bits", bits).withColumn("own", F.get("bits", F.col("step") - 1)).withColumn("before", below)

    def total(kind: str, keep) -> Column:
        return F.aggregate(F.filter("masks", lambda m: keep(m["mask"])), F.lit(0).cast("long"), lambda a, m: a + m[kind])

    own, before = F.col("own"), F.col("before")
    fails = lambda mask: mask.bitwiseAND(own) != 0
    gone = lambda mask: mask.bitwiseAND(before) != 0
    removed_here = lambda mask: fails(mask) & ~gone(mask)
    rows = steps.select(
        "part",
        "filter_order",
        "step",
        own,
        total("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total("n", removed_here).alias("removed"),
        total("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("n", lambda m: m == own).alias("unique_fails"),
        total("good_n", removed_here).alias("good_lost"),
        total("toxic_n", removed_here).alias("toxic_lost"),
    )
    shares = rows.groupBy("part", "own").agg(F.sum("removed").alias("shapley"))
    return rows.join(shares, ["part", "own"]).drop("own")


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", batches: int = BATCHES) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley) for all parts, orders and steps; see ``counters`` for odd rows."""
    return effects(counters(docs, labels, part, batches))
