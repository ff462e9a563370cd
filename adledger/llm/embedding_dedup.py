"""Near-duplicate embeddings: cross-polytope hashing after fast Hadamard rotations, with multiprobe.

1. Equal vectors of a label are a class with a count; its least id stands for it.
2. A table hashes a vector with ``k`` rotations. Each is three rounds of random signs and a fast
   Hadamard transform; its code is the axis the vector lies nearest to, with the sign. A vector
   joins the bucket of its ``k`` codes and the ``PROBES - 1`` next best ones. ``k`` follows the
   logarithm of the largest label, from ``LEAST_K`` on, so that buckets stay small. The number of tables follows from the
   rate at which random pairs *at the threshold* share a bucket, measured on ``PAIRS`` of them: the
   chance to miss such a pair is below ``MISS``, and less for closer ones. Both are set for every
   width of vectors on its own.
3. Candidates are the pairs of a bucket. All are verified by their cosine in double precision. A
   pair counts in the least of the buckets it shares, so links are counted once without being
   listed: a task hands on, per vector, how many it found and one link towards its group.
4. Components of those links.

Small buckets are verified many at a time, large ones as pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adledger.llm.common import small_batches
from adledger.llm.links import Forest, components, in_blocks
from adledger.storage import stage

THRESHOLD = 0.93
PROBES = 4
LEAST_K = 2  # rotations of a table
MISS = 1e-6
PAIRS = 4_000
BLOCK = 1_500  # members of a block of a large bucket
SMALL = 24  # members of a bucket that is verified along with others
CHUNK = 4_000  # rows of small buckets in a task's group, about
_NEAREST = 4  # axes of a rotation that probes are made of


@lru_cache(maxsize=8)
def signs(width: int, rotations: int) -> np.ndarray:
    """The random signs of every round of every rotation; the same on all executors."""
    return np.random.default_rng(width).choice(np.array([-1.0, 1.0]), size=(rotations, 3, width))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / math.sqrt(width)


def probes(vectors: np.ndarray, k: int, tables: int) -> np.ndarray:
    """Bucket numbers (vector, table, probe) of unit vectors, the best first in a table."""
    n, dim = vectors.shape
    width = 1 << max(1, dim - 1).bit_length()
    padded = np.zeros((n, width))
    padded[:, :dim] = vectors
    turns = signs(width, tables * k)
    near = min(_NEAREST, width)
    out = np.zeros((n, tables, PROBES), np.uint64)
    for table in range(tables):
        codes, losses = np.zeros((n, 1), np.uint64), np.zeros((n, 1))
        for turn in turns[table * k : (table + 1) * k]:
            rotated = padded
            for sign in turn:
                rotated = hadamard(rotated * sign)
            size = np.abs(rotated)
            axes = np.argpartition(-size, near - 1, axis=1)[:, :near]
            height = np.take_along_axis(size, axes, 1)
            positive = np.take_along_axis(rotated, axes, 1) > 0
            code = (axes * 2 + positive).astype(np.uint64)
            loss = (height.max(axis=1, keepdims=True) - height) ** 2
            # Best sums over the rotations so far; more than PROBES are never needed.
            codes = (codes[:, :, None] * np.uint64(2 * width + 1) + code[:, None, :] + np.uint64(1)).reshape(n, -1)
            losses = (losses[:, :, None] + loss[:, None, :]).reshape(n, -1)
            best = np.argsort(losses, axis=1, kind="stable")[:, :PROBES]
            codes, losses = np.take_along_axis(codes, best, 1), np.take_along_axis(losses, best, 1)
        # With fewer axes than probes the best is repeated.
        out[:, table] = np.pad(codes, ((0, 0), (0, PROBES - codes.shape[1])), mode="edge")
    return out


@lru_cache(maxsize=8)
def tables_for(dim: int, k: int, threshold: float) -> int:
    """Tables that make a miss at the threshold rarer than ``MISS``."""
    if dim < 2:
        return 1
    random = np.random.default_rng(7)
    x, z = random.normal(size=(2, PAIRS, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * z
    a, b = probes(x, k, 4), probes(y, k, 4)
    rate = float((a[:, :, :, None] == b[:, :, None, :]).any(axis=(2, 3)).mean())
    return math.ceil(math.log(MISS) / math.log(1 - min(rate, 0.999)))


def _unit(raw: list[bytes]) -> np.ndarray:
    vectors = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _hashed(classes: DataFrame, plan: dict[int, tuple[int, int]]) -> DataFrame:
    """(id, copies, vector, keys) of every class; a key stands for label, width, table and bucket.

    ``plan`` holds (rotations, tables) by width; vectors of other widths have no keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            widths = np.asarray(vectors.value_lengths())
            ends = np.cumsum(widths)
            raw = [v.tobytes() for v in np.split(flat, ends[:-1])] if len(ends) else []
            keys: list = [[]] * len(raw)
            for width in set(widths.tolist()) & plan.keys():
                at = np.flatnonzero(widths == width).tolist()
                found = probes(_unit([raw[i] for i in at]), *plan[width]).reshape(len(at), -1)
                for i, row in zip(at, found.view(np.int64).tolist()):
                    keys[i] = row
            columns = [batch.column("id"), batch.column("place"), batch.column("copies"), pa.array(raw, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "place", "copies", "vector", "codes"])

    place = F.xxhash64("label", F.size("embedding")).alias("place")
    rows = classes.select("id", place, "copies", "embedding")
    made = rows.mapInArrow(run, "id long, place long, copies long, vector binary, codes array<long>")
    keys = F.transform("codes", lambda code, i: F.xxhash64("place", F.floor(i / F.lit(PROBES)), code))
    return made.select("id", "copies", "vector", keys.alias("keys"))


def _counts(keys: np.ndarray, key: int | np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether ``key`` is the least key that members i and j share, for many pairs."""
    out = np.zeros(len(i), bool)
    for s in range(0, len(i), 8192):
        a, b = keys[i[s : s + 8192]], keys[j[s : s + 8192]]
        shared = (a[:, :, None] == b[:, None, :]).any(axis=2)
        least = np.where(shared, a, np.iinfo(np.int64).max).min(axis=1)
        out[s : s + 8192] = least == (key if np.isscalar(key) else key[s : s + 8192])
    return out


def _verify(table: pa.Table, threshold: float) -> pa.Table:
    """(a, b, n): per vector with links in these buckets, one towards its group and their number."""
    table = table.sort_by([("key", "ascending"), ("id", "ascending")])
    key, ids = table.column("key").to_numpy(), table.column("id").to_numpy()
    copies, own = table.column("copies").to_numpy(), table.column("own").to_numpy()
    apart = bool(table.column("x")[0].as_py() != table.column("y")[0].as_py())
    raw = table.column("vector").to_pylist()
    lists = table.column("keys").to_pylist()
    most = max(map(len, lists))
    # Fewer tables go with another width: a key again changes nothing.
    keys = np.array([k + k[-1:] * (most - len(k)) for k in lists], np.int64)
    vectors = _unit(raw) if len({len(r) for r in raw}) == 1 else None
    first, second = [], []

    def found(i: np.ndarray, j: np.ndarray) -> None:
        keep = (own[i] != own[j]) if apart else np.ones(len(i), bool)
        i, j = i[keep], j[keep]
        counted = _counts(keys, key[i], i, j)
        first.append(i[counted])
        second.append(j[counted])

    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(starts, len(key)))
    small = np.repeat(sizes <= SMALL, sizes)
    if vectors is not None:
        for offset in range(1, min(SMALL, int(sizes.max(initial=1)))):
            i = np.flatnonzero(small[:-offset] & (key[offset:] == key[:-offset]))
            if not len(i):
                break
            close = np.einsum("ij,ij->i", vectors[i], vectors[i + offset]) >= threshold
            found(i[close], i[close] + offset)
    for start, size in zip(starts.tolist(), sizes.tolist()):
        if vectors is not None and size <= SMALL:
            continue
        here = vectors[start : start + size] if vectors is not None else _unit(raw[start : start + size])
        for row in range(0, size, 512):
            close = here[row : row + 512] @ here[row:].T >= threshold
            i, j = np.nonzero(close)
            later = j > i
            found(i[later] + start + row, j[later] + start + row)
    i, j = np.concatenate([*first, np.zeros(0, np.intp)]), np.concatenate([*second, np.zeros(0, np.intp)])
    members, number = np.unique(ids[np.concatenate([i, j])], return_inverse=True)
    a, b = number[: len(i)], number[len(i) :]
    n = np.bincount(a, copies[j], len(members)) + np.bincount(b, copies[i], len(members))
    forest = Forest(len(members))
    for pair in np.unique(a.astype(np.int64) << 32 | b).tolist():
        forest.join(pair >> 32, pair & 0xFFFFFFFF)
    roots = np.array([forest.find(m) for m in range(len(members))], np.intp)
    return pa.table({"a": members, "b": members[roots], "n": n.astype(np.int64)}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]))


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``rows`` (vec_id, embedding, label).

    Vectors are linked if their labels are equal and their cosine, in double precision, is at least
    ``threshold``. A vector that is null, empty, zero or holds null or non-finite components, or has
    no label or id, links with nothing, and vectors of different length do not link. Equal rows link
    with each other. Other columns are not read; an empty table gives no rows.
    """
    spark = rows.sparkSession
    small_batches(spark)
    vector = F.col("embedding")
    sound = (
        F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
        & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    )
    prints = ["label", "f1", "f2"]
    given = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(sound, F.col("label")).alias("label"),
        F.when(sound, F.xxhash64("embedding")).alias("f1"),
        F.when(sound, F.xxhash64(F.lit("again"), "embedding", F.size("embedding"))).alias("f2"),
        F.size("embedding").alias("width"),
    )
    least = given.where("f1 is not null").groupBy(*prints).agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.min("width").alias("width")
    )
    least = stage(least, "vectors-least")
    widths = least.groupBy("label", "width").agg(F.count("*").alias("n")).groupBy("width")
    widths = widths.agg(F.max("n").alias("most"), F.sum("n").alias("n")).where("most > 1").collect()
    plan = {}
    for r in widths:
        k = max(LEAST_K, round(math.log(r.most) / math.log(2 * max(2, r.width))))
        plan[r.width] = k, tables_for(r.width, k, threshold)
    texts = rows.where(sound).select(F.col("vec_id").cast("long").alias("id"), "label", "embedding", F.xxhash64("embedding").alias("f1"))
    classes = texts.join(least.select("id", "f1", "copies"), ["id", "f1"]).dropDuplicates(["id", "label", "f1"])
    hashed = stage(_hashed(classes, plan), "vectors-hashed")

    bucketed = hashed.select("id", F.explode(F.array_distinct("keys")).alias("key"))
    sizes = bucketed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = bucketed.join(sizes, "key").join(hashed, "id")
    dealt = in_blocks(members, "id", "size", BLOCK, ("key",))
    chunks = max(1, round(sum(r.n * plan[r.width][1] for r in widths) * PROBES / CHUNK))
    chunk = F.when(F.col("size") > BLOCK, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(chunks)))
    dealt = dealt.select(chunk.alias("chunk"), "x", "y", "own", "key", "id", "copies", "vector", "keys")
    verified = dealt.groupBy("chunk", "x", "y").applyInArrow(lambda table: _verify(table, threshold), "a long, b long, n long")
    links = stage(verified, "vectors-links")
    counts = links.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    found = least.join(counts, "id", "left").join(components(links.select("a", "b")), "id", "left")
    found = found.select(
        *prints,
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "id").alias("component_id"),
    )
    component = F.coalesce("component_id", "vec_id")
    return given.join(found, prints, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
