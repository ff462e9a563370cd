"""Periodic runs of words: maximal stretches that repeat with a period, from suffix trees.

1. A sieve that loses nothing: a run of length L >= max(24, 3q) and period q has L - q >= 16 words
   in a row that equal the word q further on, so all of its words lie in 16-word shingles that
   occur again in the text. Stretches of such shingles are all that is looked at below.
2. The stretches of a batch, each with an end mark of its own, are joined. Ukkonen's algorithm
   builds the suffix trees of that and of its reversal.
3. An Euler tour of a tree notes the string depth at every step. The least depth between two
   leaves is that of their lowest common ancestor, so it is how far two suffixes agree. Block minima
   and a sparse table answer that in constant time, for all candidates at once.
4. Every run has a Lyndon root, which for one of the two orders of words is the longest Lyndon word
   at its place and reaches to the next smaller (or, turned around, next greater) suffix. These two
   candidates of every place are extended in both directions, and long enough ones are runs.

The smallest period follows from the root, because a Lyndon word is no repetition of a shorter one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from adledger.llm.common import slices, small_batches

LEAST, TIMES = 24, 3  # a run has so many words, and so many periods, at least
SHINGLE = 16  # the least L - q over all periods, for which see above: q = 8
JOINED = 40_000  # words of stretches that share a tree; a longer stretch has one to itself
_BLOCK = 32  # steps of the tour

RUNS = "array<struct<start: long, length: long, period: long>>"


def suffix_tree(text: list[int], width: int) -> tuple[dict[int, int], list[int], list[int], list[int]]:
    """Ukkonen's tree of ``text`` over symbols below ``width``; the last symbol is unique.

    Edges by ``node * width + symbol``; start and end of every node's label; leaves by suffix.
    """
    size = len(text)
    edges: dict[int, int] = {}
    find = edges.get
    start, stop, link, leaves = [0], [0], [0], []
    node = edge = length = waiting = 0
    for i, symbol in enumerate(text):
        waiting += 1
        made = 0  # the inner node that still needs its suffix link
        while waiting:
            if not length:
                edge = i
            key = node * width + text[edge]
            child = find(key)
            if child is None:
                edges[key] = len(start)
                leaves.append(len(start))
                start.append(i)
                stop.append(size)
                link.append(0)
                if made:
                    link[made] = node
                made = 0
            else:
                begin = start[child]
                label = (stop[child] if stop[child] <= i else i + 1) - begin
                if length >= label:
                    edge += label
                    length -= label
                    node = child
                    continue
                if text[begin + length] == symbol:
                    length += 1
                    if made:
                        link[made] = node
                    break
                inner = len(start)
                edges[key] = inner
                start += (begin, i)
                stop += (begin + length, size)
                link += (0, 0)
                start[child] = begin + length
                edges[inner * width + text[begin + length]] = child
                edges[inner * width + symbol] = inner + 1
                leaves.append(inner + 1)
                if made:
                    link[made] = inner
                made = inner
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return edges, start, stop, leaves


class Agreement:
    """How far two suffixes of a text agree, for arrays of pairs; and the suffixes' order."""

    def __init__(self, text: list[int], width: int):
        edges, start, stop, leaves = suffix_tree(text, width)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        to = np.fromiter(edges.values(), np.int64, len(edges))[order]
        owner = keys[order] // width
        del edges
        nodes = len(start)
        label = (np.array(stop, np.int64) - np.array(start, np.int64)).tolist()
        above = np.zeros(nodes, np.int64)
        above[to] = owner
        turn = np.searchsorted(owner, np.arange(nodes + 1))
        above, kids, ends, turn = above.tolist(), to.tolist(), turn[1:].tolist(), turn[:-1].tolist()
        depth, first, tour = [0] * nodes, [0] * nodes, []
        visit = tour.append
        node = 0
        while True:
            visit(depth[node])
            k = turn[node]
            if k < ends[node]:
                turn[node] = k + 1
                child = kids[k]
                depth[child] = depth[node] + label[child]
                first[child] = len(tour)
                node = child
            elif node:
                node = above[node]
            else:
                break
        self.place = np.array(first, np.int64)[leaves]
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[np.argsort(self.place)] = np.arange(len(leaves))
        steps = np.array(tour + [tour[-1]] * (-len(tour) % _BLOCK), np.int64).reshape(-1, _BLOCK)
        self.steps = steps.ravel()
        self.up_to = np.minimum.accumulate(steps, axis=1).ravel()
        self.on_from = np.minimum.accumulate(steps[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [steps.min(axis=1)]
        while 1 << len(self.table) <= len(steps):
            low, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(low[:-half], low[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common symbols from ``a`` and ``b`` on; the two differ."""
        x, y = self.place[a], self.place[b]
        x, y = np.minimum(x, y), np.maximum(x, y)
        out = np.minimum(self.on_from[x], self.up_to[y])
        left, right = x // _BLOCK + 1, y // _BLOCK
        same = np.flatnonzero(left > right)
        if len(same):  # within a block: its few steps one by one
            least = self.steps[x[same]]
            for i in range(1, _BLOCK):
                least = np.minimum(least, self.steps[np.minimum(x[same] + i, y[same])])
            out[same] = least
        level = np.frexp(np.maximum(right - left, 1).astype(float))[1] - 1
        for k in range(len(self.table)):
            at = np.flatnonzero((right > left) & (level == k))
            out[at] = np.minimum(out[at], np.minimum(self.table[k][left[at]], self.table[k][right[at] - (1 << k)]))
        return out


def _next_smaller(rank: list[int]) -> np.ndarray:
    """The next place with a smaller number; the size where there is none."""
    size = len(rank)
    found = [size] * (size + 1)
    for i in range(size - 2, -1, -1):
        own, j = rank[i], i + 1
        while j < size and rank[j] > own:
            j = found[j]
        found[i] = j
    return np.array(found[:size], np.int64)


def runs_of(stretches: list[np.ndarray]) -> list[np.ndarray]:
    """(start, length, period) of the runs of every stretch of word numbers, in order."""
    sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
    marks = len(stretches) + 1  # end marks come before all words; the last one ends the reversal
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    words = np.unique(np.concatenate(stretches), return_inverse=True)[1]
    text = np.empty(int(sizes.sum()) + len(stretches), np.int64)
    text[ends] = np.arange(len(stretches))
    owner = np.repeat(np.arange(len(stretches)), sizes)
    places = np.arange(len(words)) + owner
    text[places] = words + marks
    width = int(text.max()) + 1
    forward = Agreement(text.tolist(), width)
    rank = forward.rank
    roots = []
    for order in (rank, -rank):
        follow = _next_smaller(order.tolist())[places]
        inside = follow < ends[owner]
        roots.append(np.column_stack([places[inside], follow[inside], owner[inside]]))
    a, b, owner = np.concatenate(roots).T
    period = b - a
    right = forward(a, b)
    del forward
    # Only what is long enough with all that could be on the left is looked at from there.
    hope = (a - begins[owner]) + period + right >= np.maximum(LEAST, TIMES * period)
    a, b, owner, period, right = a[hope], b[hope], owner[hope], period[hope], right[hope]
    if not len(a):
        return [np.zeros((0, 3), np.int64)] * len(stretches)
    backward = Agreement([*text[::-1].tolist(), marks - 1], width)
    left = backward(len(text) - a, len(text) - b)
    length = left + period + right
    long = length >= np.maximum(LEAST, TIMES * period)
    found = np.unique(np.column_stack([owner, a - left - begins[owner], period, length])[long], axis=0)
    cut = np.searchsorted(found[:, 0], np.arange(len(stretches) + 1))
    return [found[x:y][:, [1, 3, 2]] for x, y in zip(cut[:-1], cut[1:])]


def sieve(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of ``words`` (texts one after the other, of the given
    lengths) whose shingles occur again in their text. All runs lie in one."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    code = (words.astype(np.uint64) + np.uint64(1)) * mix
    code ^= code >> np.uint64(29)
    for step in (1, 2, 4, 8):
        code = code[:-step] * np.uint64(0xBF58476D1CE4E5B9) + code[step:]
        code ^= code >> np.uint64(31)
        if len(code) <= step:
            break
    if len(words) < SHINGLE + 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    whole = np.flatnonzero(owner[: len(code)] == owner[SHINGLE - 1 :])
    code = (code[whole] ^ owner[whole].astype(np.uint64) * np.uint64(0x94D049BB133111EB)) * mix
    order = np.argsort(code)
    again = code[order[1:]] == code[order[:-1]]
    twice = np.unique(np.concatenate([order[1:][again], order[:-1][again]]))
    starts = whole[twice]
    new = np.diff(starts, prepend=-SHINGLE - 1) > SHINGLE
    new |= np.diff(owner[starts], prepend=-1) != 0
    last = np.append(new[1:], True) if len(starts) else new
    return starts[new], starts[last] + SHINGLE


def find_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """(start, length, period) of the runs of every text, given as words; by start, then period."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    empty = np.zeros((0, 3), np.int64)
    out = [empty] * len(texts)
    if not lengths.sum():
        return out
    flat = pa.array([w for words in texts for w in words], pa.large_binary())
    words = pc.dictionary_encode(flat).indices.to_numpy()
    begin, end = sieve(words, lengths)
    wide = end - begin >= LEAST
    begin, end = begin[wide], end[wide]
    ends = np.cumsum(lengths)
    owner = np.searchsorted(ends, begin, side="right")
    at = 0
    while at < len(begin):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(end[at:] - begin[at:]), JOINED, side="right")) + at)
        found = runs_of([words[x:y] for x, y in zip(begin[at:upto], end[at:upto])])
        for k, runs in enumerate(found, at):
            if len(runs):
                text = int(owner[k])
                runs = runs + [begin[k] - (ends[text] - lengths[text]), 0, 0]
                out[text] = np.concatenate([out[text], runs])
        at = upto
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, joined by spaces, without those after the first period of a run."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def _runs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        found, texts = [], []
        for part in slices(pa.RecordBatch.from_arrays([batch], ["text"]), "text"):
            words = [(t or b"").split() for t in part.column(0).cast(pa.binary()).to_pylist()]
            runs = find_runs(words)
            found += runs
            texts += map(collapsed, words, runs)
        ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
        columns = np.concatenate([np.zeros((0, 3), np.int64), *found]).T
        rows = pa.StructArray.from_arrays([pa.array(c) for c in columns], ["start", "length", "period"])
        lists = pa.ListArray.from_arrays(ends, rows)
        yield pa.StructArray.from_arrays([lists, pa.array(texts, pa.binary()).cast(pa.string())], ["runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, runs, collapsed) of every row: the runs by start, then period, and the text without
    the words that a run repeats, its words joined by one space.

    Words are what ASCII white space parts. A run has its smallest period, ``LEAST`` words and
    ``TIMES`` periods at least, and cannot be longer on either side; runs may overlap. A null text
    counts as empty; without words, both results are empty. Repeated rows and null keys get a row
    each. An empty table gives no rows. Other columns are not read, and nothing is shuffled. Memory
    grows with the longest stretch of one text whose shingles occur again, by about 700 bytes a word.
    """
    small_batches(docs.sparkSession)
    run = F.arrow_udf(_runs, f"runs {RUNS}, collapsed string")
    rows = docs.select(F.col(key).alias("key"), run(F.col(text)).alias("found"))
    return rows.select(F.col("key").alias(key), "found.runs", "found.collapsed")


def longest(runs: str = "runs") -> Column:
    """The run with the most periods, told exactly; the first of equals. Null without runs."""
    more = "CASE WHEN a IS NULL OR r.length * a.period > a.length * r.period THEN r ELSE a END"
    empty = "CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>)"
    return F.expr(f"aggregate({runs}, {empty}, (a, r) -> {more})")


def plant_runs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``text`` changed so that one text in ten, told by its key, ends in a run: a known
    workload for the query.

    With h the crc32 of the key as text and g = h div 10, the n words of texts with h % 10 = 0
    repeat from word a = g % n on, with period 1 + (n - a) div (3 + g % 8). Other texts, those
    without words and those without a key stay as they are. Columns ``_words`` and ``_from`` are lost.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    n, a = F.size("_words"), F.col("_from")
    found = docs.withColumn("_words", words).withColumn("_from", F.when(n > 0, g % n).cast("int"))
    period = (F.lit(1) + F.floor((n - a) / (g % 8 + 3))).cast("int")
    times = F.ceil((n - a) / period).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice("_words", a + 1, period), times)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice("_words", F.lit(1), a), again), " ")
    return found.withColumn(text, F.when(a.isNotNull(), planted).otherwise(F.col(text))).drop("_words", "_from")
