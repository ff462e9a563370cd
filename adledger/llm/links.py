"""Linking at scale: large buckets dealt as pairs of blocks, and connected components of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from adledger.storage import stage


def in_blocks(rows: DataFrame, member: str, size: str | Column, block: int, key: tuple[str, ...]) -> DataFrame:
    """Deal the members of every bucket so that any two meet in one (key, x, y), and no task gets
    more than two blocks.

    ``size`` is the bucket's number of members. A bucket of up to ``block`` members is the one
    group (0, 0). A larger one is cut into blocks by a hash of the member; the members of block b
    join the groups (b, y) and (x, b). Adds x, y and ``own``, the member's block.
    """
    size = F.col(size) if isinstance(size, str) else size
    blocks = F.ceil(size / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(F.lit("block"), F.col(member), *key), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    dealt = rows.withColumn("_blocks", blocks).withColumn("own", own).withColumn("_other", other)
    return dealt.withColumns({"x": F.least("own", "_other"), "y": F.greatest("own", "_other")}).drop("_blocks", "_other")


class Forest:
    """Union-find over the numbers 0 to n - 1; the root is the least member."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)

    def edges(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, id of its root) of everything that is not a root."""
        roots = np.array([self.find(i) for i in range(len(self.parent))], np.intp)
        moved = roots != np.arange(len(roots))
        return ids[moved], ids[roots[moved]]


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id on an edge (a, b); the root is the least id reachable.

    Large and small stars by turns: every id's neighbours are hung on the least one it knows, until
    nothing moves. The number of rounds grows with the logarithm of the graph. Every round is a
    table in the shared folder. The least neighbour is found with partial aggregates, and the join
    to hand it out has one row per id on one side, so an id with any number of edges is split.
    """
    pairs = edges.where("a is not null and b is not null and a <> b")
    pairs = stage(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _mark(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hung = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(hung.where("a <> b").distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        pairs = stage(small.where("a <> b").distinct(), "links")
        mark = _mark(pairs)
        if mark == seen:
            break
        seen = mark
    roots = pairs.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots.unionByName(pairs.select(F.col("b").alias("id"), F.col("b").alias("root"))).distinct()


def _mark(pairs: DataFrame) -> tuple:
    """Tells two sets of pairs apart."""
    hashed = F.xxhash64("a", "b")
    return tuple(pairs.agg(F.count("*"), F.bit_xor(hashed), F.sum(F.shiftright(hashed, 20))).first())
