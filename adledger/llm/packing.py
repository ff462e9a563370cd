"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

Documents become token ids, an end mark follows each, and longer ones are cut into pieces of the
sequence length. Pieces are dealt to groups of bounded size. Every group evolves on several
islands. A solution is a set of whole bins, and crossover works on bins: well-filled bins of one
parent are injected into the other, bins that hold any of their pieces again are dissolved, and
displaced pieces go where they fit best. After every epoch the elite of an island migrates to the
next one. Then bins that are not well filled leave their groups: their pieces are pooled, dealt
anew and evolved again, until one group holds what is left. The pool shrinks by orders of
magnitude each time, so the whole costs little more than its first round.
"""

from __future__ import annotations

import json
import random
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from adledger.llm.byte_bpe import LONG, Pairs, bounds, lists, padded_rows
from adledger.llm.common import slices, small_batches
from adledger.storage import stage

LENGTH = 4096
END = 1
GROUP = 2_000  # pieces of a group, about
ISLANDS, EPOCHS, POPULATION, GENERATIONS = 2, 2, 4, 24  # generations end at the least number of bins
SLACK = 48  # a bin with more free places than this is not well filled
# Characters whose lower case, letters and digits are the same in every library: printable ASCII and
# the letters of Latin-1. What they make up is cut here, anything else by the tokenizer itself.
_COMMON = "^[!-~À-ÖØ-öø-ÿ]+$"
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|\n|[^\na-zß-öø-ÿ0-9]+")


class Words:
    """Token ids of texts. Chunks between ASCII white space are independent, so every different one
    of a batch is looked at once; so is every different piece of them, all merged in matrices."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        described = json.loads(self.tokenizer.to_str())
        model, self.special = described["model"], [t["content"] for t in described["added_tokens"]]
        ids, merges = model["vocab"], [tuple(m) for m in model["merges"]]
        left, right = (np.array([ids[m[k]] for m in merges]) for k in (0, 1))
        merged = np.array([ids[a + b] for a, b in merges], np.int32)
        if not (np.diff(merged) > 0).all():
            raise ValueError("the ids of merged tokens do not follow the order of the merges")
        self.pairs = Pairs(left, right, merged)
        # Printable bytes stand for themselves in such a vocabulary, the others for letters from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.inner, self.last = (
            np.array([ids[letter[b] + end] for b in range(256)], np.int32) for end in ("", model["end_of_word_suffix"])
        )

    def _merge(self, pieces: pa.Array) -> pa.ListArray:
        """Ids of pieces, none of them empty."""
        starts, lengths, data = bounds(pieces)
        ids = self.inner[data]
        ids[starts + lengths - 1] = self.last[data[starts + lengths - 1]]
        short = lengths <= LONG
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))]
        found += self.pairs.merge_rows(padded_rows(np.flatnonzero(short), starts, lengths, ids))
        for i in np.flatnonzero(~short).tolist():
            long = self._ask([pieces[i].as_py()])[0]
            found.append((np.array([i]), np.array([len(long)]), long))
        return lists(len(pieces), found)

    def _ask(self, texts: list[str]) -> list[np.ndarray]:
        """Ids by the tokenizer."""
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, chunks: pa.Array) -> pa.ListArray:
        """Ids of chunks, none of them empty or with white space."""
        common = pc.match_substring_regex(chunks, _COMMON).to_numpy(zero_copy_only=False).copy()
        for token in self.special:
            common &= ~pc.match_substring(chunks, token).to_numpy(zero_copy_only=False)
        here, rest = np.flatnonzero(common), np.flatnonzero(~common)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))]
        if len(here):
            joined = "\n".join(chunks.take(pa.array(here)).to_pylist()).lower() + "\n"
            coded = pa.array(_PIECES.findall(joined), pa.string()).dictionary_encode()
            index = coded.indices.to_numpy()
            ends = np.flatnonzero(index == pc.index(coded.dictionary, "\n").as_py())
            merged = self._merge(coded.dictionary)
            # The line's end, which is no piece, has the size 0.
            sizes = pc.list_value_length(merged).to_numpy()[index]
            sizes[ends] = 0
            total = np.cumsum(sizes)
            real = np.delete(index, ends)
            found.append((here, np.diff(total[ends], prepend=0), merged.take(pa.array(real)).flatten().to_numpy()))
        if len(rest):
            ids = self._ask(chunks.take(pa.array(rest)).to_pylist())
            found.append((rest, np.array([len(i) for i in ids], np.int64), np.concatenate(ids)))
        return lists(len(chunks), found)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Token ids of texts in UTF-8."""
        if not texts:
            return []
        split = [t.split() for t in texts]
        coded = pa.array(chain.from_iterable(split), pa.binary()).dictionary_encode()
        known = self._chunks(coded.dictionary.cast(pa.string()))
        sizes = pc.list_value_length(known).to_numpy()[coded.indices.to_numpy()]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([len(s) for s in split])]
        flat = known.take(coded.indices).flatten().to_numpy().astype(np.uint32)
        return np.split(flat, ends[:-1])


@lru_cache(maxsize=1)
def words(path: str) -> Words:
    """One vocabulary per worker process."""
    return Words(path)


def pieces_of(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of all documents; a null text has the end mark only."""
    small_batches(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                owner = []
                for i, ids in enumerate(known.encode([t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()])):
                    ids = np.append(ids, np.uint32(end))
                    for number, start in enumerate(range(0, len(ids), length)):
                        cut = ids[start : start + length].astype("<u4")
                        owner.append(i)
                        rows.append((number, start, len(cut), zlib.crc32(cut.tobytes())))
                columns = [part.column("doc_id").take(pa.array(owner, pa.int32()))]
                columns += [pa.array(c, pa.int32() if k == 0 else pa.int64()) for k, c in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Solution:
    """Bins of pieces; finds the fullest bin a piece fits in by a bit set of free places."""

    def __init__(self, sizes: list[int], length: int):
        self.sizes, self.length = sizes, length
        self.bins: list[list[int]] = []
        self.free: list[int] = []
        self.with_free: dict[int, list[int]] = {}
        self.mask = 0

    def _offer(self, number: int) -> None:
        free = self.free[number]
        if free:
            self.with_free.setdefault(free, []).append(number)
            self.mask |= 1 << free

    def add_bin(self, members: list[int]) -> None:
        self.bins.append(list(members))
        self.free.append(self.length - sum(self.sizes[i] for i in members))
        self._offer(len(self.bins) - 1)

    def fit(self, piece: int) -> None:
        size = self.sizes[piece]
        fitting = self.mask >> size
        if not fitting:
            self.add_bin([piece])
            return
        free = (fitting & -fitting).bit_length() - 1 + size
        holders = self.with_free[free]
        number = holders.pop()
        if not holders:
            self.mask &= ~(1 << free)
        self.bins[number].append(piece)
        self.free[number] = free - size
        self._offer(number)

    def fit_all(self, pieces: list[int], rng: random.Random | None = None) -> Solution:
        """Best fit in falling order, which ``rng`` blurs."""
        blur = (lambda i: self.sizes[i] * (0.85 + 0.3 * rng.random())) if rng else self.sizes.__getitem__
        for piece in sorted(pieces, key=blur, reverse=True):
            self.fit(piece)
        return self

    def cost(self) -> tuple[int, int]:
        """Fewer bins are better; then free places in few bins rather than many."""
        return len(self.bins), -sum(f * f for f in self.free)


def crossover(first: Solution, second: Solution, rng: random.Random) -> Solution:
    """Inject well-filled bins of ``second`` into ``first``."""
    ranked = sorted(range(len(second.bins)), key=lambda b: second.free[b] + rng.random())
    # Bins are drawn from the better filled part, each with the same chance.
    injected = [b for b in ranked[: max(1, len(ranked) * 3 // 4)] if rng.random() < 0.5] or ranked[:1]
    child = Solution(first.sizes, first.length)
    taken = set()
    for b in injected:
        child.add_bin(second.bins[b])
        taken.update(second.bins[b])
    displaced = []
    for members in first.bins:
        if taken.isdisjoint(members):
            child.add_bin(members)
        else:
            displaced += [i for i in members if i not in taken]
    return child.fit_all(displaced)


def mutate(solution: Solution, rng: random.Random) -> Solution:
    """Dissolve the emptiest bin and a few others, and fit their pieces anew."""
    order = sorted(range(len(solution.bins)), key=lambda b: -solution.free[b])
    gone = {*order[:2], *rng.sample(order, min(len(order), max(1, len(order) // 20)))}
    child = Solution(solution.sizes, solution.length)
    for b, members in enumerate(solution.bins):
        if b not in gone:
            child.add_bin(members)
    loose = [i for b in sorted(gone) for i in solution.bins[b]]
    rng.shuffle(loose)
    return child.fit_all(loose, rng)


def evolve(sizes: list[int], elites: list[list[int]], seed: int, length: int) -> list[int]:
    """The bin of every piece after an epoch on one island. ``elites``: bins of earlier solutions."""
    rng = random.Random(seed)
    least = -(-sum(sizes) // length)
    everything = range(len(sizes))
    population = []
    for bins in elites:
        solution = Solution(sizes, length)
        members: dict[int, list[int]] = {}
        for piece, b in enumerate(bins):
            members.setdefault(b, []).append(piece)
        for b in sorted(members):
            solution.add_bin(members[b])
        population.append(solution)
    if not population:
        population.append(Solution(sizes, length).fit_all(everything))
    while len(population) < POPULATION and population[0].cost()[0] > least:
        population.append(Solution(sizes, length).fit_all(everything, rng))
    for _ in range(GENERATIONS):
        population.sort(key=Solution.cost)
        if population[0].cost()[0] <= least:
            break
        parents = rng.sample(population, 2) if len(population) > 1 else population * 2
        child = crossover(*sorted(parents, key=Solution.cost), rng)
        population.append(mutate(child, rng))
        population.append(child)
        population = sorted(population, key=Solution.cost)[:POPULATION]
    best = min(population, key=Solution.cost)
    out = [0] * len(sizes)
    for b, members in enumerate(best.bins):
        for piece in members:
            out[piece] = b
    return out


_SOLVED = "grp long, island int, uid long, length long, bin int"


def _epoch(rows: DataFrame, number: int, length: int) -> DataFrame:
    """Evolve every (grp, island); ``elite`` numbers the solutions that its rows bring along."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        grp, island = (int(k) for k in key)
        group = group.sort_values(["elite", "uid"], kind="stable")
        parts = [part for _, part in group.groupby("elite")]
        first = parts[0]
        elites = [part["bin"].tolist() for part in parts] if number else []
        bins = evolve(first["length"].tolist(), elites, grp * 1009 + island * 101 + number, length)
        return pd.DataFrame(
            {"grp": grp, "island": np.int32(island), "uid": first["uid"].to_numpy(), "length": first["length"].to_numpy(), "bin": np.array(bins, np.int32)}
        )

    return rows.groupBy("grp", "island").applyInPandas(run, _SOLVED)


def _round(rows: DataFrame, number: int, total: int, length: int) -> DataFrame:
    """(uid, length, sequence_id, free) for rows (uid, length): one deal, all its epochs."""
    groups = max(1, round(total / GROUP))
    grp = F.pmod(F.xxhash64(F.lit(number), F.col("uid")), F.lit(groups))
    island = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))
    state = rows.select(grp.alias("grp"), island.alias("island"), "uid", "length", F.lit(0).alias("bin"), F.lit(0).alias("elite"))
    for epoch in range(EPOCHS):
        solved = stage(_epoch(state, epoch, length), "packing-epoch")
        migrant = solved.withColumn("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int"))
        state = solved.withColumn("elite", F.lit(0)).unionByName(migrant.withColumn("elite", F.lit(1)))
    bins = solved.groupBy("grp", "island", "bin").agg((length - F.sum("length")).alias("free"))
    costs = bins.groupBy("grp", "island").agg(F.count("*").alias("bins"), F.sum(F.col("free") * F.col("free")).alias("squares"))
    best = costs.groupBy("grp").agg(F.min(F.struct("bins", -F.col("squares"), "island")).alias("best"))
    chosen = best.select("grp", F.col("best.island").alias("island"))
    # A deal has fewer than 2**32 groups, and a group fewer than 2**24 bins.
    sequence = F.shiftleft(F.lit(number).cast("long"), 56) + F.shiftleft(F.col("grp"), 24) + F.col("bin")
    return (
        solved.join(chosen, ["grp", "island"])
        .join(bins, ["grp", "island", "bin"])
        .select("uid", "length", sequence.alias("sequence_id"), "free")
    )


def pack(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """All columns of ``pieces`` (with ``length``) and ``sequence_id``, ``offset`` in the sequence.

    Every piece is 1 to ``length`` long, or the job fails. Equal rows are packed each; an empty
    table gives no rows. Columns named like the added ones, or ``_uid``, are replaced.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset", "_uid")]
    checked = F.when(F.col("length").between(1, length), F.col("length")).otherwise(
        F.raise_error(F.lit("a piece does not fit into a sequence")).cast("long")
    )
    # Numbers by partition and row; written once, so that they stay what they are.
    numbered = pieces.select(*names, F.monotonically_increasing_id().alias("_uid")).withColumn("length", checked)
    known = stage(numbered, "packing-pieces")
    total = known.count()
    rows = known.select(F.col("_uid").alias("uid"), "length")
    placed, left, left_bins = None, total, None
    for deal in range(1, 64):
        solved = stage(_round(rows, deal, left, length), "packing-round")
        if left_bins is not None and solved.select("sequence_id").distinct().count() >= left_bins:
            placed = placed.unionByName(pool)
            break
        pool = solved.where(F.col("free") > SLACK)
        good = solved.where(F.col("free") <= SLACK)
        placed = good if placed is None else placed.unionByName(good)
        size = pool.agg(F.count("*").alias("n"), F.count_distinct("sequence_id").alias("bins")).first()
        if left <= GROUP or size.n > left // 2:
            placed = placed.unionByName(pool)
            break
        rows, left, left_bins = pool.select("uid", "length"), size.n, size.bins
    before = Window.partitionBy("sequence_id").orderBy("_uid").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    joined = known.join(placed.select(F.col("uid").alias("_uid"), "sequence_id"), "_uid")
    return joined.withColumn("offset", offset).drop("_uid")


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces of ``docs``.

    ``tokenizer`` is the path of a tokenizers file on the executors. A null or empty text is a
    piece of one end mark. Repeated rows are packed each. Other columns are not read.
    """
    return pack(pieces_of(docs, tokenizer, length, end), length)
