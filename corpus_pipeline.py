"""A corpus in five stages: filter, identify, deduplicate twice, pack.

Every stage takes all that its predecessor kept and, but for the last, returns the columns of
``documents``. ``run`` writes each result to the shared folder and reads it back for the next.
SQL cannot express the stages; the tests compare them with plain versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adledger.llm import exact_dedup as exact, language, minhash, packing, toxicity
from adledger.llm.common import fold, small_batches, table
from adledger.storage import stage

TOXIC = 0.5  # documents that score as much or more are rejected

ORACLE_SQL = None


def _without(docs: DataFrame, gone: DataFrame, sha256: Column) -> DataFrame:
    """Documents but those that ``gone`` names by doc_id (which may be null) and text_sha256."""
    gone = gone.select("doc_id", "text_sha256").distinct()
    same = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (sha256 == gone["text_sha256"])
    return docs.join(gone, same, "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that score as toxic; learned from the labelled rows among ``docs``."""
    small_batches(spark)
    score = toxicity.scorer(*toxicity.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0))
    return docs.where(score(F.col("text")) < TOXIC)


def drop_unreadable(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents in no language: without text, or without a letter in it. What could be
    learned does not matter."""
    small_batches(spark)
    found = language.predictor(*language.learn(docs, fold("doc_id", 4) != 2))
    return docs.where(found(F.col("text"))["lettered"])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every group of equal texts."""
    labels = stage(exact.exact_dedup(docs), "pipeline-copies")
    sha256 = exact.sha256_of(exact.normalised(docs["text"]))
    left = _without(docs, labels.where("not kept"), sha256)
    twice = labels.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if twice.isEmpty():
        return left
    # Rows of a group that share the id that is kept: the longest text, found by partial aggregates.
    twice = stage(twice, "pipeline-repeated")
    same = left["doc_id"].eqNullSafe(twice["doc_id"])
    order = F.struct(-F.char_length("text"), "text", F.xxhash64(*docs.columns))
    repeated = left.join(twice, same, "left_semi").groupBy("doc_id", sha256.alias("text_sha256"))
    repeated = repeated.agg(F.min_by(F.struct(*docs.columns), order).alias("row")).select("row.*")
    return left.join(twice, same, "left_anti").unionByName(repeated)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of every group of near copies. Texts that share an id, or
    have none, are documents of their own; those without an id come last."""
    repeated = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if repeated.isEmpty():
        gone = minhash.near_duplicates(docs).where("not kept").select("doc_id")
        return docs.join(gone.distinct(), "doc_id", "left_anti").select(docs.columns)
    # One number per id and text, in the order of the ids.
    sha256 = exact.sha256_of(F.coalesce(docs["text"], F.lit("")))
    rows = docs.select("doc_id", sha256.alias("text_sha256")).distinct()
    rows = rows.orderBy(F.col("doc_id").asc_nulls_last(), "text_sha256")
    numbers = stage(rows.withColumn("number", F.monotonically_increasing_id()), "pipeline-numbers")
    same = docs["doc_id"].eqNullSafe(numbers["doc_id"]) & (sha256 == numbers["text_sha256"])
    numbered = docs.join(numbers, same).select(numbers["number"].alias("doc_id"), docs["text"])
    gone = minhash.near_duplicates(numbered).where("not kept").select(F.col("doc_id").alias("number")).distinct()
    return _without(docs, stage(numbers.join(gone, "number", "left_semi"), "pipeline-near"), sha256)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences: a row per piece, with its sequence and place."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unreadable),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
