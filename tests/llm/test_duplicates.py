"""Operators 3, 6, 8 and 9 against plain versions."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adledger.llm import catalogue, embedding_dedup, exact_dedup, links, minhash, oracles, sharding

from .conftest import SF_DIR

WHITE = " \t\n\x0b\x0c\r"


# Exact duplicates


def plain_exact(rows):
    squeeze = lambda t: (t or "").translate({ord(c): None for c in WHITE})
    groups = {}
    for number, text in rows:
        groups.setdefault(squeeze(text), []).append((-len(text or ""), number is None, number or 0, number))
    out = []
    for number, text in rows:
        group = groups[squeeze(text)]
        keep = min(group)[3]
        sha = hashlib.sha256(squeeze(text).encode()).hexdigest()
        out.append((number, keep, len(group), number == keep, sha))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [256, 4])
def test_exact_of_awkward_rows(awkward, bits):
    """A digest of four bits collides all the time; the bytes decide."""
    short = lambda sha: F.substring(sha, 1, bits // 4)
    rows = exact_dedup.exact_dedup(awkward, digest=short).collect()
    expected = plain_exact([(r.doc_id, r.text) for r in awkward.collect()])
    assert sorted(map(tuple, rows), key=str) == expected


def test_exact_of_nothing(nothing):
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_exact_query(spark, documents):
    rows = catalogue.op8_exact_dedup(spark, SF_DIR)
    assert sorted(map(tuple, rows.collect()), key=str) == plain_exact([(r.doc_id, r.text) for r in documents.collect()])


def test_exact_sql(documents):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    rows = con.execute(oracles.ORACLES["op8_exact_dedup"]).fetchall()
    assert sorted(rows, key=str) == plain_exact([(r.doc_id, r.text) for r in documents.collect()])


def test_exact_is_native(awkward):
    plan = exact_dedup.exact_dedup(awkward)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_state_goes_on_after_a_restart(spark, folder):
    """A second batch finds what the first left in the state."""
    schema = "doc_id long, text_sha256 string, points long, file string, digest string"
    for number, digest in ((1, "a"), (2, "b"), (3, "a")):
        spark.createDataFrame([(number, digest, number, "f", digest)], schema).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        exact_dedup.watch(stream, f"{folder}/state", f"{folder}/updates").awaitTermination()
    known = {r.digest: (r.group_size, -r.best.neg_id) for r in exact_dedup.latest(spark, f"{folder}/updates").collect()}
    assert known == {"a": (2, 3), "b": (1, 2)}


# Near duplicates


def plain_shingles(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in words.translate({ord(c): " " for c in WHITE}).split(" ") if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_near(rows, percent=85):
    sets = {number: plain_shingles(text) for number, text in rows if number is not None}
    root = {n: n for n in sets}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    holders = {}
    for n, s in sets.items():
        for shingle in s:
            holders.setdefault(shingle, set()).add(n)
    for a, b in {tuple(sorted(p)) for h in holders.values() for p in itertools.combinations(h, 2)}:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    out = []
    for number, text in rows:
        size = len(plain_shingles(text))
        component = None if number is None else find(number)
        out.append((number, size, component, component == number))
    return sorted(out, key=str)


def near(frame, **options):
    return sorted(map(tuple, minhash.near_duplicates(frame, **options).collect()), key=str)


def test_near_of_awkward_rows(awkward):
    assert near(awkward) == plain_near([(r.doc_id, r.text) for r in awkward.collect()])


def test_near_of_nothing(nothing):
    assert minhash.near_duplicates(nothing).count() == 0


def test_near_query(spark, documents):
    rows = sorted(map(tuple, catalogue.op6_minhash(spark, SF_DIR).collect()), key=str)
    assert rows == plain_near([(r.doc_id, r.text) for r in documents.collect()])


def family(rng, size, edits, words=120):
    """Copies of one text, each with a few words changed; they are linked through the text."""
    base = [f"w{rng.randint(0, 999)}" for _ in range(words)]
    out = [" ".join(base)]
    for k in range(size):
        copy = list(base)
        for _ in range(rng.randint(1, edits)):
            copy[rng.randrange(words)] = f"e{k}{rng.randint(0, 9)}"
        out.append(" ".join(copy))
    return out


def test_near_in_blocks(spark, monkeypatch):
    """Groups far larger than a block, with links at the threshold and passages that many share."""
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = family(rng, 60, 2) + family(rng, 40, 3) + family(rng, 30, 2, 40)
    texts += [passage + " " + " ".join(f"r{rng.random()}" for _ in range(90)) for _ in range(40)]
    texts += [" ".join(f"l{i}" for i in range(1500)), " ".join(f"l{i}" for i in range(60, 1560)), "a b", "A  B", "a b c"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = plain_near(rows)
    assert near(frame) == expected
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(minhash, "BLOCK_ELEMENTS", 1500)
    assert near(frame) == expected


def test_bounds_keep_every_link():
    rng = np.random.default_rng(3)
    for _ in range(300):
        size, share = int(rng.integers(1, 1500)), rng.random() * 0.25
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        gone = rng.random(len(a)) < share / 2
        b = np.unique(np.concatenate([a[~gone], rng.integers(0, 1 << 63, int(gone.sum()), dtype=np.uint64)]))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        expected = 100 * both >= 85 * (len(a) + len(b) - both)
        assert minhash.linked(a, b, 85) == expected
        sketch = [
            minhash.sketches(s, np.zeros(len(s), np.intp), 1, 64 if len(s) >= 1000 else 8)[0].tobytes() for s in (a, b)
        ]
        forest = links.Forest(2)
        minhash._may_link(np.array([len(a), len(b)]), sketch, 85, forest, None)
        if expected:
            assert forest.find(1) == 0


def test_components(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, i) for i in range(1001, 1200)]
    rest = [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(300)]
    edges = path + star + rest + [(7, 7), (None, 3)]
    rng.shuffle(edges)
    root = {}

    def find(n):
        while root.setdefault(n, n) != n:
            n = root[n]
        return n

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    found = {r.id: r.root for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: find(n) for n in root}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Embeddings


def plain_vectors(rows, threshold=0.93):
    def sound(v):
        return v and None not in v and all(map(math.isfinite, v)) and any(v)

    known = [r for r in rows if r[0] is not None and r[2] is not None and sound(r[1])]
    units = [np.array(v, float) / np.abs(v).max() for _, v, _ in known]
    units = [u / np.linalg.norm(u) for u in units]
    root = {r[0]: r[0] for r in rows if r[0] is not None}
    degree = Counter()

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, j in itertools.combinations(range(len(known)), 2):
        if known[i][2] == known[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
            degree[known[i][0]] += 1
            degree[known[j][0]] += 1
            x, y = find(known[i][0]), find(known[j][0])
            root[max(x, y)] = min(x, y)
    out = []
    for number, _, _ in rows:
        component = None if number is None else find(number)
        out.append((number, degree[number], component, number == component))
    return sorted(out, key=str)


def vectors(spark, rows):
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "vec_id long, embedding array<float>, label int, key string, copies string")
    return sorted(map(tuple, embedding_dedup.near_vectors(frame).collect()), key=str)


def test_vectors_of_awkward_rows(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 4.5]
    rows = [
        (1, a, 1), (2, a, 1), (3, b, 1), (4, a, 2), (5, a, None), (6, None, 1), (7, [], 1), (8, [0.0] * 4, 1),
        (9, [1.0, None, 3.0, 4.0], 1), (10, [1.0, float("nan"), 3.0, 4.0], 1), (11, [float("inf"), 2.0, 3.0, 4.0], 1),
        (12, [-x for x in a], 1), (13, [x * 1e30 for x in a], 1), (None, [9.0, 1.0, 1.0, 1.0], 1), (15, [1.0, 2.0], 1),
        (16, [1.0, 2.1], 1), (17, [5.0], 1), (18, [6.0], 1),
    ]
    assert vectors(spark, rows) == plain_vectors(rows)
    assert vectors(spark, []) == []


def test_vectors_in_blocks(spark, monkeypatch):
    """Dense groups, chains at the threshold and background, in blocks far smaller than a group."""
    rng = np.random.default_rng(5)
    rows = []
    for group in range(6):
        center = rng.normal(size=24)
        spread = rng.uniform(0.05, 0.4)
        rows += [center + spread * rng.normal(size=24) for _ in range(60)]
    rows += list(rng.normal(size=(200, 24)))
    rows = [(i, [float(np.float32(x)) for x in v], int(rng.integers(0, 3))) for i, v in enumerate(rows)]
    expected = plain_vectors(rows)
    assert sum(r[1] for r in expected) > 500
    assert vectors(spark, rows) == expected
    monkeypatch.setattr(embedding_dedup, "BLOCK", 9)
    monkeypatch.setattr(embedding_dedup, "SMALL", 3)
    assert vectors(spark, rows) == expected


@pytest.mark.parametrize("short", [[[1.0]], [[1.0], [2.0], [1.0, 2.0], [1.0, 2.1], [5.0] * 130]])
def test_short_vectors_in_front(spark, short):
    """Pairs of wide vectors near the threshold are all found, whatever widths come first."""
    rng = np.random.default_rng(8)
    x, z = rng.normal(size=(2, 200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    wide = np.concatenate([x, 0.931 * x + math.sqrt(1 - 0.931**2) * z])
    rows = [(i, [float(np.float32(c)) for c in v], 1) for i, v in enumerate([*short, *wide])]
    expected = plain_vectors(rows)
    assert sum(r[1] for r in expected) >= 400
    assert vectors(spark, rows) == expected


def test_vectors_query(spark):
    frame = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = sorted(map(tuple, catalogue.op3_embeddings(spark, SF_DIR).collect()), key=str)
    assert rows == plain_vectors([(r.vec_id, r.embedding, r.label) for r in frame.collect()])


def test_hadamard_keeps_length():
    x = np.random.default_rng(1).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(embedding_dedup.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(embedding_dedup.hadamard(embedding_dedup.hadamard(x)), x)


# Shards


def plain_shard(key, tree):
    """The descent in plain Python."""
    path, here = "", list(tree)
    for depth in range(3):
        children = {}
        for s in here:
            children.setdefault(str(s.shard) if depth == 2 else s[depth], []).append(s)
        if len(children) > 1:
            def draw(name):
                u = (int(hashlib.md5(f"{key}/{path}/{name}".encode()).hexdigest()[:12], 16) + 1) / 16**12
                return -math.log(u) / sum(s.weight for s in children[name])

            name = min(sorted(children), key=draw)
        else:
            (name,) = children
        path, here = f"{path}/{name}", children[name]
    return here[0].shard


def check_sharded(rows, source):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == [*range(len(s))] for s in slots.values())
    grown = sharding.grow(sharding.EIGHT)
    expected = []
    for number, text in source:
        key, raw = "" if number is None else str(number), (text or "").encode()
        expected.append((number, len(raw) + 1, zlib.crc32(raw), "key", plain_shard(key, sharding.EIGHT), plain_shard(key, grown)))
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in rows), key=str) == sorted(expected, key=str)


def test_shards_query(spark, documents):
    rows = catalogue.op9_sharding(spark, SF_DIR).collect()
    check_sharded(rows, [(r.doc_id, r.text) for r in documents.collect()])
    assert all(r.grown_shard in (r.shard, 8) for r in rows)


def test_shards_of_awkward_rows(awkward, nothing):
    check_sharded(sharding.shard_rows(awkward).collect(), [(r.doc_id, r.text) for r in awkward.collect()])
    assert sharding.shard_rows(nothing).count() == 0


def test_weights_and_movement(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    tree = (*sharding.EIGHT[:7], sharding.EIGHT[7]._replace(weight=3.0))
    heavier = (*sharding.EIGHT[:7], sharding.EIGHT[7]._replace(weight=4.0))
    rows = ids.select(
        sharding.shard_of(F.col("doc_id"), tree).alias("a"), sharding.shard_of(F.col("doc_id"), heavier).alias("b")
    ).collect()
    share = Counter(r.a for r in rows)
    assert abs(share[7] / 20_000 - 0.3) < 0.02 and abs(share[0] / 20_000 - 0.1) < 0.02
    # Within the region whose weights did not change, no row moves between its shards.
    assert all(r.a == r.b for r in rows if r.a < 4 and r.b < 4)
    assert all(r.a == r.b or r.b >= 4 for r in rows)


def test_bad_trees():
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit(1), ())
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit(1), (sharding.EIGHT[0], sharding.EIGHT[0]))


def test_a_third_of_all_rows_equal(spark):
    """Hot texts, ids and rows give the plain results."""
    rows = [(i if i % 3 else None, "the same text " if i % 3 == 0 else f"text {i % 500}") for i in range(3000)]
    rows += [(7, "an equal row")] * 1500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = exact_dedup.exact_dedup(docs)
    groups = {r.text_sha256: r.group_size for r in found.collect()}
    assert found.count() == len(rows) and {1000, 1500} <= set(groups.values())
    placed = sharding.shard_rows(docs)
    per = placed.groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("slots"), F.max("slot").alias("last"))
    assert all(r.n == r.slots == r.last + 1 for r in per.collect())
    assert sum(r.n for r in per.collect()) == len(rows)
