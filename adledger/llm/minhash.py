"""Near-duplicate documents by MinHash with tensored banding, links confirmed on full sets.

A table key is a pair (left half i, right half j) of ``HALVES`` left and as many right halves of
``WIDTH`` minhashes each. ``2 * HALVES * WIDTH`` minhashes thus fill ``HALVES ** 2`` tables. Two
documents of similarity s miss each other with probability 1 - (1 - (1 - s**WIDTH)**HALVES)**2,
2e-5 at 0.85.

1. Signatures: halves, set size, a fingerprint of the set, and a parity sketch (below).
2. Documents with the same set are a class; its least id stands for it from here on.
3. A half that nobody shares cannot be part of a shared key, so keys are formed of shared halves
   only. Of buckets with the same members one is looked at.
4. In a bucket, pairs are sifted by bounds that every link keeps: the sizes, and the parity
   sketches, whose Hamming distance is at most the size of the symmetric difference. What
   passes, passes exactly; nothing else is lost. Connected members make up clusters.
5. In a cluster, links are confirmed on full sets, made anew from the texts. A pair that is
   connected already is not looked at again, so dense groups cost about one comparison per member.
6. Components of the confirmed links.

Buckets and clusters of any size are dealt as pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from adledger.llm.common import slices, small_batches
from adledger.llm.links import Forest, components, in_blocks
from adledger.storage import stage

SHINGLE = 5
HALVES, WIDTH = 12, 3
PERCENT = 85  # of the union that the intersection has to be
BLOCK = 1_500  # members of a block of a bucket
BLOCK_ELEMENTS = 1_000_000  # shingles of a block of a cluster, about
_SHORT, _LONG, _LONG_FROM = 8, 64, 1_000  # 64-bit words of a sketch; a long one from so many shingles
_SEED = np.random.default_rng(20240817)
_FACTORS = _SEED.integers(1, 1 << 63, 2 * HALVES * WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _SEED.integers(0, 1 << 63, 2 * HALVES * WIDTH, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str) -> np.ndarray:
    """The set of a text as sorted 64-bit hashes."""
    words = text.encode().lower().split()  # lower-cases A-Z and splits at ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(hashed) < SHINGLE:
        out = np.full(1, len(hashed), np.uint64)
        for h in hashed:
            out = out * _P + h
        return _mix(out)
    n = len(hashed) - SHINGLE + 1
    out = hashed[:n].copy()
    for k in range(1, SHINGLE):
        out = out * _P + hashed[k : k + n]
    return np.unique(_mix(out))


def sketches(flat: np.ndarray, owner: np.ndarray, count: int, words: int) -> np.ndarray:
    """Parity of every document's hashes in each of ``64 * words`` places."""
    bits = np.zeros((count, 64 * words), np.uint8)
    place = (flat % np.uint64(64 * words)).astype(np.intp)
    cell = owner * (64 * words) + place
    odd = np.unique(cell, return_counts=True)
    bits.ravel()[odd[0][odd[1] % 2 == 1]] = 1
    return np.packbits(bits, axis=1).view(np.uint64)


def _sign(sets: list[np.ndarray]) -> dict[str, list]:
    """Signatures of non-empty sets."""
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets)
    starts = np.cumsum(lengths) - lengths
    least = [np.minimum.reduceat(flat * f + t, starts) for f, t in zip(_FACTORS, _TERMS)]
    halves = []
    for i in range(2 * HALVES):
        half = least[i * WIDTH]
        for k in range(1, WIDTH):
            half = half * _P + least[i * WIDTH + k]
        halves.append(_mix(half).view(np.int64))
    owner = np.repeat(np.arange(len(sets)), lengths)
    sketch: list[bytes] = [b""] * len(sets)
    for long_one in (False, True):
        chosen = np.flatnonzero((lengths >= _LONG_FROM) == long_one)
        number = np.full(len(sets), -1)
        number[chosen] = np.arange(len(chosen))
        mine = number[owner] >= 0
        made = sketches(flat[mine], number[owner[mine]], len(chosen), _LONG if long_one else _SHORT)
        for i, row in zip(chosen.tolist(), made):
            sketch[i] = row.tobytes()
    return {
        "f1": np.add.reduceat(_mix(flat ^ _P), starts).view(np.int64).tolist(),
        "f2": np.add.reduceat(_mix(flat + _P), starts).view(np.int64).tolist(),
        "halves": np.stack(halves, axis=1).tolist(),
        "sketch": sketch,
    }


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n, f1, f2, halves, sketch); the last four are null for a document without words."""
    small_batches(docs.sparkSession)
    fields = [("f1", pa.int64()), ("f2", pa.int64()), ("halves", pa.list_(pa.int64())), ("sketch", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingles(t or "") for t in part.column("text").to_pylist()]
                full = [i for i, s in enumerate(sets) if len(s)]
                made = _sign([sets[i] for i in full]) if full else {}
                columns = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64())]
                for name, kind in fields:
                    values = [None] * len(sets)
                    for i, value in zip(full, made.get(name, ())):
                        values[i] = value
                    columns.append(pa.array(values, kind))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", *(name for name, _ in fields)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, f1 long, f2 long, halves array<long>, sketch binary")


def _keys(classes: DataFrame) -> DataFrame:
    """(key, id) of all tensored keys with two members or more, of one bucket per set of members."""
    half = classes.select("id", F.posexplode("halves").alias("i", "h")).select("id", "i", F.xxhash64("i", "h").alias("h"))
    shared = half.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    left = F.sort_array(F.collect_list(F.when(F.col("i") < HALVES, F.col("h"))))
    right = F.sort_array(F.collect_list(F.when(F.col("i") >= HALVES, F.col("h"))))
    sides = half.join(shared, "h").groupBy("id").agg(left.alias("left"), right.alias("right"))
    sides = stage(sides.where("size(left) > 0 and size(right) > 0"), "minhash-halves")
    pairs = sides.select("id", F.explode("left").alias("l"), "right").select("id", "l", F.explode("right").alias("r"))
    keys = pairs.select("id", F.xxhash64("l", "r").alias("key"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("c"), F.sum(F.shiftright(F.xxhash64("id"), 20)).alias("s"), F.bit_xor(F.xxhash64("id")).alias("x"))
    once = buckets.where("c > 1").groupBy("c", "s", "x").agg(F.min("key").alias("key")).select("key", "c")
    return keys.join(once, "key")


def _fold(sketch: np.ndarray) -> np.ndarray:
    """A long sketch as a short one: places that are equal modulo the short length add up."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, _SHORT), axis=0)


def _may_link(n: np.ndarray, sketch: list[bytes], percent: int, forest: Forest, between: np.ndarray | None) -> None:
    """Join members that sizes and sketches allow to be linked. ``between``: the block of each, if
    only pairs of different blocks are wanted."""
    wide = [np.frombuffer(s, np.uint64) for s in sketch]
    short = np.stack([w if len(w) == _SHORT else _fold(w) for w in wide])
    for i in range(len(n) - 1):
        after = slice(i + 1, None)
        # |A ∩ B| / |A ∪ B| >= p / 100 means |A △ B| <= (100 - p) / (100 + p) * (|A| + |B|).
        allowed = (100 - percent) * (n[i] + n[after])
        distance = np.bitwise_count(short[after] ^ short[i]).sum(axis=1, dtype=np.int64)
        passes = ((100 + percent) * np.maximum(distance, abs(n[after] - n[i])) <= allowed)
        if between is not None:
            passes &= between[after] != between[i]
        for j in (np.flatnonzero(passes) + i + 1).tolist():
            if forest.find(i) == forest.find(j):
                continue
            if len(wide[i]) == len(wide[j]) == _LONG:
                distance_ij = int(np.bitwise_count(wide[i] ^ wide[j]).sum())
                if (100 + percent) * distance_ij > (100 - percent) * int(n[i] + n[j]):
                    continue
            forest.join(i, j)


def linked(first: np.ndarray, second: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough."""
    a, b = (first, second) if len(first) <= len(second) else (second, first)
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _edges(table: pa.Table, join) -> pa.Table:
    forest = Forest(table.num_rows)
    join(table, forest)
    a, b = forest.edges(table.column("id").to_numpy())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _clusters(classes: DataFrame, percent: int) -> DataFrame:
    """(id, root) of all members of a bucket that bounds allow to be linked with another."""
    members = _keys(classes).join(classes.select("id", "n", "sketch"), "id")

    def sift(table: pa.Table) -> pa.Table:
        def join(table: pa.Table, forest: Forest) -> None:
            own, x, y = (table.column(c).to_numpy() for c in ("own", "x", "y"))
            between = own if x[0] != y[0] else None
            _may_link(table.column("n").to_numpy(), table.column("sketch").to_pylist(), percent, forest, between)

        return _edges(table.sort_by("id"), join)

    dealt = in_blocks(members, "id", "c", BLOCK, ("key",)).select("key", "x", "y", "own", "id", "n", "sketch")
    return components(dealt.groupBy("key", "x", "y").applyInArrow(sift, "a long, b long"))


def _confirmed(docs: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """(a, b) links that connect what full sets connect, from one text of every class."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(clusters, "id")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingles(t or "") for t in part.column("text").to_pylist()]
                found = [pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("root"), *found], ["id", "root", "elements", "n"])

    sets = stage(texts.mapInArrow(make, "id long, root long, elements binary, n long"), "minhash-sets")
    sizes = sets.groupBy("root").agg(F.sum("n").alias("total"))

    def confirm(table: pa.Table) -> pa.Table:
        def join(table: pa.Table, forest: Forest) -> None:
            sets = [np.frombuffer(e, np.uint64) for e in table.column("elements").to_pylist()]
            own, x, y = (table.column(c).to_numpy() for c in ("own", "x", "y"))
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            short = np.concatenate([sketches(s, np.zeros(len(s), np.intp), 1, _SHORT) for s in sets])
            for i in range(len(sets) - 1):
                distance = np.bitwise_count(short[i + 1 :] ^ short[i]).sum(axis=1, dtype=np.int64)
                passes = (100 + percent) * np.maximum(distance, abs(n[i + 1 :] - n[i])) <= (100 - percent) * (n[i] + n[i + 1 :])
                if x[0] != y[0]:
                    passes &= own[i + 1 :] != own[i]
                for j in (np.flatnonzero(passes) + i + 1).tolist():
                    if forest.find(i) != forest.find(j) and linked(sets[i], sets[j], percent):
                        forest.join(i, j)

        return _edges(table.sort_by("id"), join)

    # Blocks by elements rather than by members: long sets take more room.
    dealt = in_blocks(sets.join(sizes, "root"), "id", "total", BLOCK_ELEMENTS, ("root",))
    dealt = dealt.select("root", "x", "y", "own", "id", "elements")
    return dealt.groupBy("root", "x", "y").applyInArrow(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Documents are linked if 100 * |intersection| >= percent * |union| of their sets of five-word
    shingles (the whole sequence for fewer words). A null text or one without words has the empty
    set and links with nothing, as does a row without an id. Rows that share an id are one document.
    Ties cannot matter: a component's id is its least one. Columns other than the two are not read.
    """
    signed = stage(signatures(docs), "minhash-signatures")
    known = signed.where("n > 0 and doc_id is not null")
    fingerprint = ["n", "f1", "f2"]
    least = known.groupBy(*fingerprint).agg(F.min("doc_id").alias("id"))
    classes = stage(
        known.join(least, fingerprint).where("doc_id = id").dropDuplicates(["id"]).select("id", "n", "halves", "sketch"),
        "minhash-classes",
    )
    clusters = stage(_clusters(classes, percent), "minhash-clusters")
    roots = components(stage(_confirmed(docs, clusters, percent), "minhash-links"))
    found = least.join(roots, "id", "left").select(*fingerprint, F.coalesce("root", "id").alias("component_id"))
    rows = signed.select("doc_id", *fingerprint).join(found, fingerprint, "left")
    component = F.coalesce("component_id", "doc_id")
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )
