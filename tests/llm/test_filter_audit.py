"""Operator 12: the stream's counters and the effects against a plain count."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from adledger.llm import filter_audit
from adledger.storage import run_folder

LABELS = "doc_id long, quality int, toxic int"


def plain_mask(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    a = len(words) < 200
    b = 100 * len(set(words)) < 50 * len(words)
    c = 100 * len(re.findall("[A-Z]", text)) > 2 * len(text)
    return a + 2 * b + 4 * c + 8 * bool(re.search(r"[#$%&*|]", text))


def plain_counters(docs, labels):
    first = {}
    for d in docs:
        if d["doc_id"] is not None:
            first[d["text"] or ""] = min(d["doc_id"], first.get(d["text"] or "", d["doc_id"]))
    out = Counter()
    for d in docs:
        text = d["text"] or ""
        later = d["doc_id"] is not None and d["doc_id"] > first[text]
        flag = lambda k: int(any(l[0] == d["doc_id"] and l[k] == 1 for l in labels if l[0] is not None))  # noqa: B023, E731
        out[d["source"] or "", plain_mask(text) + 16 * later, flag(1), flag(2)] += 1
    return dict(out)


def plain_effects(counts):
    out = {}
    for part in {k[0] for k in counts}:
        rows = [(mask, good, toxic, n) for (p, mask, good, toxic), n in counts.items() if p == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order):
                bit = 1 << "ABCDE".index(letter)
                before = sum(1 << "ABCDE".index(f) for f in order[:step])
                here = [r for r in rows if r[0] & bit and not r[0] & before]
                removed = sum(r[3] for r in here)
                shapley[letter] += removed
                out[part, "".join(order), step + 1] = [
                    sum(r[3] for r in rows if not r[0] & (bit | before)), removed,
                    sum(r[3] for r in rows if r[0] & bit and r[0] & before), sum(r[3] for r in rows if r[0] == bit),
                    sum(r[3] for r in here if r[1]), sum(r[3] for r in here if r[2]), letter,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return out


def tables(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mask string, n string, digest string")
    return docs, spark.createDataFrame(labels, LABELS)


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(4)
    texts = ["", " \t ", "one", "ONE two", "a # b", " ".join(f"w{i}" for i in range(230)), "w " * 250, "W " * 250, None]
    rows = []
    for i in range(400):
        text = texts[0] if i % 3 == 0 else rng.choice(texts)
        rows.append((rng.choice([None, *range(300)]), text, rng.choice([None, "", "s", "t", "s"]), "x", "y", "z"))
    labels = [(rng.randrange(300), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(200)] + [(None, 1, 1)]
    return rows, labels


def collected(counts):
    return {(r.part, r.mask, r.good, r.toxic): r.n for r in counts.collect()}


def test_counters_of_odd_rows_in_many_batches(spark, random_rows):
    rows, labels = random_rows
    docs, known = tables(spark, rows, labels)
    want = plain_counters([{"doc_id": r[0], "text": r[1], "source": r[2]} for r in rows], labels)
    counts = filter_audit.counters(docs.repartition(7), known, batches=7)
    assert collected(counts) == want
    effects = filter_audit.effects(counts)
    found = {(r.part, r.filter_order, r.step): [*r][3:] for r in effects.collect()}
    assert found == plain_effects(want)


def test_smaller_ids_that_arrive_later_retract(spark):
    """Batches go on where the last ended, each with smaller ids of the same texts."""
    folder = run_folder(spark, "test-audit")
    texts = ["same text", "other text"]
    rows = [(1000 - i, texts[i % 2], "stu"[i // 20], "", "", "") for i in range(60)]
    labels = [(1000 - i, 1, 0) for i in range(0, 60, 7)]
    schema = None
    for start in range(0, 60, 20):
        docs, known = tables(spark, rows[start : start + 20], labels)
        arrivals = filter_audit.arrivals_of(docs, known)
        schema = arrivals.schema
        arrivals.coalesce(1).write.mode("append").parquet(f"{folder}/arrivals")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/arrivals")
        filter_audit.watch(stream, f"{folder}/state", f"{folder}/changes", 3).awaitTermination()
        changes = spark.read.parquet(f"{folder}/changes")
        counts = changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")
        so_far = [{"doc_id": r[0], "text": r[1], "source": r[2]} for r in rows[: start + 20]]
        assert collected(counts) == plain_counters(so_far, labels)
    assert changes.where("n < 0").count() > 0
    assert changes.select("batch").distinct().count() == 3


def test_copies_are_combined_before_the_state(spark):
    """A text with very many copies reaches its key as a few rows."""
    rows = spark.range(20_000).selectExpr("id", "'p' AS part", "CAST('same' AS binary) AS digest", "3 AS mask", "0 AS good", "0 AS toxic")
    combined = rows.coalesce(2).mapInArrow(filter_audit._combine, filter_audit._COMBINED)
    assert combined.where("digest is not null").count() <= 10
    assert combined.agg(F.sum("n")).first()[0] == 20_000


def test_awkward_and_empty_tables(spark, awkward, nothing):
    labels = spark.createDataFrame([], LABELS)
    docs = [r.asDict() for r in awkward.collect()]
    counts = filter_audit.counters(awkward, labels)
    assert collected(counts) == plain_counters(docs, [])
    assert filter_audit.audit(nothing, labels).collect() == []
