"""Byte-level BPE: texts to token ids and back, merged in padded matrices.

Texts are cut by the vocabulary's pattern, and the pieces of a batch become a dictionary, so that
each different piece is merged once. A piece that is a token is done. The others are laid out as
rows of ids, padded, in one matrix per length bucket. In each round every row merges its leftmost
pair of minimum rank; pair ranks come from a hashed table. A round drops one cell per row, and rows
without a pair left leave the matrix, so it shrinks both ways. Pieces longer than ``LONG`` bytes
would need as many rounds as they have bytes, each over all of the row. They are merged one by one,
with a heap of pairs by rank and place, also the leftmost pair of minimum rank first.

Decoding takes the tokens' bytes by id; a text's bytes then lie one after the other.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from adledger.llm.common import slices, small_batches

LONG = 1024  # bytes of a piece
NO_RANK = np.iinfo(np.int32).max
_PAD = -1


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``starts[i]`` to ``starts[i] + lengths[i] - 1`` of all i, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Pairs:
    """Merges of token ids. A merged id is also the rank of its merge, up to a constant."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        """An open-addressing table of the pairs (left, right), all different."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        self.bits = max(4, (4 * len(keys)).bit_length())  # a quarter full at most
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NO_RANK, np.int32)
        slot, rest = self._slot(keys), np.arange(len(keys))
        while len(rest):
            free = rest[self.keys[slot[rest]] < 0]
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[first]], self.values[slot[first]] = keys[first], merged[first]
            rest = np.setdiff1d(rest, first)
            slot[rest] = (slot[rest] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (((keys ^ keys >> 32) * 0x1E3779B97F4A7C15 & 0x7FFFFFFFFFFFFFFF) >> (63 - self.bits)).astype(np.intp)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of every pair, which is also the merged id; ``NO_RANK`` if there is none."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], NO_RANK)
        other = np.flatnonzero((held != keys) & (held >= 0))
        while len(other):
            slot[other] = (slot[other] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[other]]
            hit = held == keys[other]
            out[other[hit]] = self.values[slot[other[hit]]]
            other = other[~hit & (held >= 0)]
        return out

    def merge_matrix(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers, rows) of rows as they get done, padded on the right."""
        number = np.arange(len(rows))
        ranks = self.rank(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(len(rows), -1)
        while len(rows):
            best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.intp)
            low = ranks[np.arange(len(rows)), best] if ranks.shape[1] else np.full(len(rows), NO_RANK)
            going = low < NO_RANK
            if not going.all():
                yield number[~going], rows[~going]
                rows, ranks, number = rows[going], ranks[going], number[going]
                best, low = best[going], low[going]
            if not len(rows):
                break
            n, width = rows.shape
            line = np.arange(n)
            rows[line, best] = low
            keep = np.ones((n, width), bool)
            keep[line, best + 1] = False
            rows = rows[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), bool)
            keep[line, best] = False  # the merged pair's rank; its neighbours' are looked up anew
            ranks = ranks[keep].reshape(n, width - 2)
            has_left = np.flatnonzero(best > 0)
            at = best[has_left]
            ranks[has_left, at - 1] = self.rank(rows[has_left, at - 1], rows[has_left, at])
            has_right = np.flatnonzero(best < width - 2)
            at = best[has_right]
            ranks[has_right, at] = self.rank(rows[has_right, at], rows[has_right, at + 1])

    def merge_rows(self, rows: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, ...]]:
        """(numbers, sizes, ids one after the other) for (numbers, padded rows), done ones first."""
        for number, padded in rows:
            for at, found in self.merge_matrix(padded):
                real = found != _PAD
                yield number[at], real.sum(axis=1), found[real]


def padded_rows(members: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> Iterator[tuple]:
    """(numbers, rows) for ``members``, by length buckets of powers of two; piece i is the stretch of
    ``ids`` from ``starts[i]`` on. No matrix has many more than 2**20 cells."""
    bucket = np.frexp(np.maximum(lengths[members] - 1, 0).astype(float))[1]
    for power in np.unique(bucket).tolist():
        width, of_width = 1 << power, members[bucket == power]
        step = max(1, (1 << 20) // width)
        for start in range(0, len(of_width), step):
            part = of_width[start : start + step]
            rows = np.full((len(part), width), _PAD, np.int32)
            rows[np.arange(width) < lengths[part, None]] = ids[_spread(starts[part], lengths[part])]
            yield part, rows


def lists(count: int, found: list[tuple[np.ndarray, ...]]) -> pa.ListArray:
    """An Arrow array of ``count`` lists from parts (numbers, sizes, ids one after the other)."""
    number, sizes, ids = (np.concatenate(x) for x in zip(*found))
    per = np.zeros(count, np.int64)
    per[number] = sizes
    ends = np.cumsum(per)
    flat = np.empty(int(per.sum()), np.int32)
    flat[_spread((ends - per)[number], sizes)] = ids
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat))


def bounds(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, bytes) of an Arrow array of strings or bytes without nulls."""
    offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
    lengths = np.diff(offsets)
    data = np.frombuffer(pieces.buffers()[2], np.uint8) if lengths.any() else np.zeros(1, np.uint8)
    return offsets[:-1], lengths, data


class Vocabulary:
    """Ranks of byte strings; the id of a token is its rank."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.known = pa.array(self.tokens, pa.binary())
        self.pieces = regex.compile(pattern)
        self._hash_pairs()

    def _hash_pairs(self) -> None:
        """Every pair of tokens whose bytes together are a token."""
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.pairs = Pairs(np.array(left), np.array(right), np.array(merged, np.int32))

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges in the same order, with a heap of (rank, place, left id, right id)."""
        size, find, tokens = len(piece), self.ranks.get, self.tokens
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        pairs = ((find(piece[i : i + 2]), i) for i in range(size - 1))
        heap = [(rank, i, ids[i], ids[i + 1]) for rank, i in pairs if rank is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= size or ids[j] != right:
                continue  # one of the two was merged with another since
            ids[i], ids[j] = rank, _PAD
            after[i] = k = after[j]
            if k < size:
                before[k] = i
                found = find(tokens[rank] + tokens[ids[k]])
                if found is not None:
                    heapq.heappush(heap, (found, i, rank, ids[k]))
            h = before[i]
            if h >= 0:
                found = find(tokens[ids[h]] + tokens[rank])
                if found is not None:
                    heapq.heappush(heap, (found, h, ids[h], rank))
        merged = np.array(ids, np.int32)
        return merged[merged != _PAD]

    def merge(self, pieces: pa.Array) -> pa.ListArray:
        """Ids of every piece of an Arrow array of strings or bytes without nulls."""
        pieces = pieces.cast(pa.binary())
        if not len(pieces):
            return pa.array([], pa.list_(pa.int32()))
        starts, lengths, data = bounds(pieces)
        whole = pc.fill_null(pc.index_in(pieces, value_set=self.known), -1).to_numpy()
        done = [(np.flatnonzero(whole >= 0), np.ones(int((whole >= 0).sum()), np.int64), whole[whole >= 0])]
        for i in np.flatnonzero((whole < 0) & (lengths > LONG)).tolist():
            ids = self._merge_long(pieces[i].as_py())
            done.append((np.array([i]), np.array([len(ids)]), ids))
        rest = np.flatnonzero((whole < 0) & (lengths > 0) & (lengths <= LONG))
        done += self.pairs.merge_rows(padded_rows(rest, starts, lengths, self.byte[data]))
        return lists(len(pieces), done)

    def encode(self, texts: list[str]) -> pa.ListArray:
        """Token ids of every text."""
        found = [self.pieces.findall(t) for t in texts]
        coded = pa.array(chain.from_iterable(found), pa.string()).dictionary_encode()
        merged = self.merge(coded.dictionary)
        sizes = pc.list_value_length(merged).to_numpy()[coded.indices.to_numpy()]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ends = total[np.cumsum([0, *map(len, found)])]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), merged.take(coded.indices).flatten())

    def decode(self, ids: pa.ListArray) -> pa.BinaryArray:
        """The bytes of every list of ids; those of null are none."""
        ids = pc.fill_null(ids, pa.scalar([], ids.type)) if ids.null_count else ids
        pieces = self.known.take(ids.flatten())
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy())])
        places = np.concatenate([[0], np.cumsum(pc.binary_length(pieces).to_numpy(), dtype=np.int64)])
        offsets = pa.array(places[ends], pa.int32()).buffers()[1]
        return pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, offsets, pieces.buffers()[2]])


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One copy per worker process."""
    return Vocabulary(path, pattern)


def encode(
    docs: DataFrame, ranks: str, pattern: str, text: str = "text", key: str = "doc_id", decoded: bool = False
) -> DataFrame:
    """(key, ids array<int>) of every row, without special tokens; ``decoded`` adds a column of that
    name with the bytes that the ids stand for.

    ``ranks`` is the path of the rank file on the executors, ``pattern`` cuts texts into pieces. A
    null or empty text has no ids. Null keys and repeated rows stay. Other columns are not read, and
    nothing is shuffled.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = words.encode([t or "" for t in part.column("text").to_pylist()])
                columns = [part.column("key"), ids, *([words.decode(ids)] if decoded else [])]
                yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "decoded"][: len(columns)])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, ids array<int>" + (", decoded binary" if decoded else "")
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded binary) of every row of (key, ids). Null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks, pattern)
        for batch in batches:
            columns = [batch.column("key"), batch.column("ids"), words.decode(batch.column("ids"))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "decoded"])

    rows = encoded.select(F.col(key).alias("key"), "ids")
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids array<int>, decoded binary").withColumnRenamed("key", key)
