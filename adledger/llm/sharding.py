"""Shards from a hierarchical weighted hash tree: regions hold racks, racks hold shards.

A row descends the tree. On each level every child draws ``-ln(u) / weight``, where ``u`` is a
hash of the row's key and the child's path, and the least draw wins; the weight of an inner node
is the sum of its shards' weights. A child therefore gets rows in proportion to its weight, and
a change of weights moves rows only between siblings on the path to the change.

The law is ``key``: the key and the tree alone decide. ``grow`` adds a shard as a region of its
own. Nothing but the root's draws changes then, and they only change by one more child, so the
new shard takes rows into itself and no other row moves.

Slots (gapless from 0 in each shard) come from two levels of ranks: a window over (shard,
bucket), plus the sizes of the buckets before it. There are about as many buckets as rows in
one, so both windows grow with the square root of a shard, and no shard meets in one task. Rows
are dealt to buckets by key and place, so that equal ones are, too.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from adledger.storage import stage

_DIGITS = 12  # hexadecimal digits of a hash in a draw: 48 bits, exact in a double


class Shard(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


EIGHT = tuple(Shard(f"region{s // 4}", f"rack{s // 2}", s) for s in range(8))


def grow(tree: tuple[Shard, ...], weight: float = 1.0) -> tuple[Shard, ...]:
    """One more shard, with the next number, in a region of its own."""
    new = max((s.shard for s in tree), default=-1) + 1
    return (*tree, Shard(f"region+{new}", f"rack+{new}", new, weight))


def _draw(key: Column, path: str, weight: float) -> Column:
    digest = F.md5(F.concat(key, F.lit(f"/{path}")).cast("binary"))
    number = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double")
    return -F.ln((number + 1.0) / float(16**_DIGITS)) / F.lit(float(weight))


def _descend(key: Column, tree: tuple[Shard, ...], depth: int, path: str) -> Column:
    """The shard below ``path``; a level with a single child needs no draw."""
    if depth == 2:
        children = {str(s.shard): [s] for s in tree}
    else:
        children = {}
        for s in tree:
            children.setdefault(s[depth], []).append(s)

    def below(name: str) -> Column:
        if depth == 2:
            return F.lit(children[name][0].shard)
        return _descend(key, tuple(children[name]), depth + 1, f"{path}/{name}")

    names = sorted(children)
    if len(names) == 1:
        return below(names[0])
    draws = F.array(
        *(
            F.struct(
                _draw(key, f"{path}/{n}", math.fsum(s.weight for s in children[n])).alias("draw"),
                F.lit(i).alias("child"),
            )
            for i, n in enumerate(names)
        )
    )
    chosen = F.array_min(draws)["child"]
    branch = F.when(chosen == 0, below(names[0]))
    for i, n in enumerate(names[1:], 1):
        branch = branch.when(chosen == i, below(n))
    return branch


def shard_of(key: Column, tree: tuple[Shard, ...]) -> Column:
    """The shard of a key. Shards of weight 0 or less get nothing; a null key counts as empty."""
    live = tuple(s for s in tree if s.weight > 0)
    if not live:
        raise ValueError("the tree has no shard with a weight")
    if len({s.shard for s in live}) != len(live):
        raise ValueError("two shards have the same number")
    return _descend(F.coalesce(key.cast("string"), F.lit("")), live, 0, "").cast("int")


def shard_rows(
    rows: DataFrame, tree: tuple[Shard, ...] = EIGHT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every row.

    ``size`` is the text's UTF-8 bytes plus 1; a null text has no bytes. Equal rows get slots
    in any order; an empty table gives none. Columns other than key and text are not read.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    buckets = max(1, math.isqrt(rows.count() // len(tree)))
    # Equal rows differ by where they were read; written once, so that they keep their bucket.
    anywhere = F.xxhash64(F.col(key), F.monotonically_increasing_id())
    placed = rows.select(
        F.col(key),
        (F.length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(key), tree).alias("shard"),
        shard_of(F.col(key), grow(tree)).alias("grown_shard"),
        F.pmod(anywhere, F.lit(buckets)).alias("_bucket"),
    )
    placed = stage(placed, "sharding")
    sizes = placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("shard", "_bucket").orderBy(key, "size", "text_crc32")
    ranked = placed.withColumn("_rank", F.row_number().over(inside))
    return ranked.join(offsets, ["shard", "_bucket"]).select(
        key,
        "size",
        "text_crc32",
        "law",
        "shard",
        (F.col("_before") + F.col("_rank") - 1).cast("long").alias("slot"),
        "grown_shard",
    )
