"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built over a bounded sample of labelled text. A text is
parsed against it from left to right into the longest matches: follow transitions while there is
one, else count a phrase and begin the next at the automaton's root. Text of a language falls into
few long phrases of its own automaton and many short ones of others. The number of phrases is
normalised by the text's length and by how many phrases unseen text of the language itself needs;
the language with the fewest wins.

Only letters carry language, so texts are read in lower case with everything else as one space.
The transitions of all automata are one hashed table, as large as the samples are long, whatever the
number of different letters. All texts of a batch are parsed in step, long ones in blocks of
``BLOCK`` characters whose parses are then carried over into each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adledger.llm.common import share, slices, small_batches

SAMPLE_ROWS = 400  # labelled rows per language, at most about
LANGUAGES = 200  # learned from, the most frequent ones
SAMPLE_CHARS = 24_000  # of text per language in an automaton
PROBE_CHARS = 12_000  # of further text per language, to see what its own text needs
BLOCK = 1024
FEW = 32  # blocks and languages that are not worth a step for all
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Code point to the lower-case letter it reads as; a space (32) where it is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for point in [*range(0xD800), *range(0xE000, 0x110000)]:
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def letters(text: str) -> np.ndarray:
    """The text's code points as read: lower-case letters with single spaces between words."""
    read = _folded()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = read == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    read = read[keep]
    return read[int(len(read) > 0 and read[0] == 32) :]


def automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions by symbol of every state of the suffix automaton of ``text``; state 0 is the root."""
    size = 2 * len(text) + 2
    link, length = [-1] * size, [0] * size
    moves: list[dict[int, int]] = [{}]
    last = 0
    for c in text:
        current = len(moves)
        moves.append({})
        length[current] = length[last] + 1
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = current
            p = link[p]
        if p < 0:
            link[current] = 0
        else:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[current] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length[clone] = length[p] + 1
                link[clone] = link[q]
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[current] = clone
        last = current
    return moves


class Parser:
    """Phrase counts of texts against every language's automaton."""

    def __init__(self, samples: dict[str, str], probes: dict[str, str]):
        self.languages = sorted(samples)
        read = {name: letters(samples[name]) for name in self.languages}
        known = np.unique(np.concatenate([*read.values(), np.array([32], np.uint32)]))
        self.symbol = np.full(0x110000, len(known), np.uint16)
        self.symbol[known] = np.arange(len(known))
        # After the first letter of a phrase: its state, or the state 0 without any transition, where
        # the sample lacks the letter, so that it is a phrase of its own. The last symbol stands for
        # letters in no sample. States of all languages share their numbers, multiples of ``width``,
        # so that state + symbol is a key.
        width = len(known) + 1
        self.begin = np.zeros((len(self.languages), width), np.int64)
        keys, to, base = [], [], width
        for i, name in enumerate(self.languages):
            moves = automaton(self.symbol[read[name]].tolist())
            for symbol, state in moves[0].items():
                self.begin[i, symbol] = base + state * width
            for state, row in enumerate(moves):
                if state:
                    keys += [base + state * width + symbol for symbol in row]
                    to += [base + follow * width for follow in row.values()]
            base += len(moves) * width
        self._hash(np.array(keys, np.int64), np.array(to, np.int64))
        self.need = np.ones(len(self.languages))
        rates = [
            self.phrases([probes[n]])[0, i] / max(1, len(letters(probes[n]))) if probes.get(n) else math.nan
            for i, n in enumerate(self.languages)
        ]
        usual = np.nanmean(rates) if not np.all(np.isnan(rates)) else 1.0
        self.need = np.array([r if r > 0 else usual for r in rates])

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        """An open-addressing table of the transitions, an eighth full at most."""
        self.shift = np.uint64(64 - max(4, (8 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        slot, rest = self._slot(keys), np.arange(len(keys))
        while len(rest):
            free = rest[self.keys[slot[rest]] < 0]
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[first]], self.values[slot[first]] = keys[first], values[first]
            rest = np.setdiff1d(rest, first)
            slot[rest] = (slot[rest] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def _step(self, state: np.ndarray, symbol: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether a phrase ended before the symbol, the state after it); ``begin`` is the state if so."""
        keys = state + symbol
        slot = self._slot(keys)
        held = self.keys[slot]
        broke = held != keys
        to = np.where(broke, begin, self.values[slot])
        other = np.flatnonzero(broke & (held >= 0))  # someone else's slot: look further
        if len(other):
            keys, slot = keys.ravel()[other], slot.ravel()[other]
            while len(other):
                slot = (slot + 1) & (len(self.keys) - 1)
                held = self.keys[slot]
                hit = held == keys
                found = other[hit]
                broke.ravel()[found] = False
                to.ravel()[found] = self.values[slot[hit]]
                further = ~hit & (held >= 0)
                other, keys, slot = other[further], keys[further], slot[further]
        return broke, to

    def _walk(self, state: int, symbols: list[int], begin: list[int], held: list[bool]) -> tuple[int, list[bool], bool]:
        """``_step`` along one stretch: the last state, whether a phrase ended before each symbol, and
        whether it stopped early, where ``held`` has a phrase end at the same place."""
        keys, values = memoryview(self.keys), memoryview(self.values)
        shift, last, out = int(self.shift), len(keys) - 1, []
        for symbol, end in zip(symbols, held):
            key = state + symbol
            slot = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> shift
            while (found := keys[slot]) != key and found >= 0:
                slot = slot + 1 & last
            broke = found < 0
            state = begin[symbol] if broke else values[slot]
            out.append(broke)
            if broke and end:
                return state, out, True
        return state, out, False

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of every text (row) in every language (column).

        Long texts are cut into blocks that are parsed at once, each as if a phrase began with it.
        Then every block is parsed again from the state in which the block before it ended, up to
        where both parses end a phrase at the same place, from where on they agree. A block whose
        last state changes that way has its follower parsed again.
        """
        read = [letters(t) for t in texts]
        lengths = np.fromiter(map(len, read), np.int64, len(read))
        out = np.zeros((len(read), len(self.languages)), np.int64)
        if not lengths.sum() or not self.languages:
            return out
        flat = self.symbol[np.concatenate(read)]
        per = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(read)), per)
        offset = (np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)) * BLOCK
        start = np.repeat(np.cumsum(lengths) - lengths, per) + offset
        size = np.minimum(lengths[owner] - offset, BLOCK)
        # Columns of blocks by size, so that those still going come first.
        order = np.argsort(-size, kind="stable")
        start, size, owner, first = start[order], size[order], owner[order], (offset == 0)[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        going = np.searchsorted(-size, -np.arange(size.max()), side="left")
        every = len(self.languages)
        breaks = np.zeros((len(going), every, len(order)), bool)
        ended = self.begin[:, flat[start]]
        for step, n in enumerate(going[1:].tolist(), 1):
            symbols = flat[start[:n] + step].astype(np.int64)
            breaks[step, :, :n], ended[:, :n] = self._step(ended[:, :n], symbols, self.begin[:, symbols])

        # The column of the block before, and of the one after in the same text (-1: none).
        before, after = np.full(len(order), -1), np.full(len(order), -1)
        later = place[1:][~first[place[1:]]]
        before[later] = place[:-1][~first[place[1:]]]
        after[before[later]] = later
        language, block = (x.ravel() for x in np.meshgrid(np.arange(every), later, indexing="ij"))
        again = False
        while len(block):
            state, rest, step = ended[language, before[block]], np.arange(len(block)), 0
            changed = []
            while len(rest) > FEW:
                l, b = language[rest], block[rest]
                symbols = flat[start[b] + step].astype(np.int64)
                broke, state = self._step(state, symbols, self.begin[l, symbols])
                # At first, every block was parsed as if a phrase had ended before it.
                agree = broke & (breaks[step, l, b] if step or again else True)
                breaks[step, l, b] = broke
                step += 1
                last = ~agree & (size[b] == step)
                moved = last & (ended[l, b] != state)
                ended[l[moved], b[moved]] = state[moved]
                changed.append(rest[moved])
                rest, state = rest[~agree & ~last], state[~agree & ~last]
            for i, from_state in zip(rest.tolist(), state.tolist()):
                l, b = int(language[i]), int(block[i])
                held = breaks[step : size[b], l, b]
                ends = held.tolist()
                if step == 0 and not again:
                    ends[0] = True
                symbols = flat[start[b] + step : start[b] + size[b]].tolist()
                to, broke, agree = self._walk(from_state, symbols, self.begin[l].tolist(), ends)
                held[: len(broke)] = broke
                if not agree and ended[l, b] != to:
                    ended[l, b] = to
                    changed.append(np.array([i]))
            changed = np.concatenate([np.zeros(0, np.int64), *changed])
            language, block = language[changed], after[block[changed]]
            language, block, again = language[block >= 0], block[block >= 0], True
        np.add.at(out, owner, breaks.sum(axis=0, dtype=np.int64).T)
        out[lengths > 0] += 1
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language with the fewest normalised phrases, how clearly it wins (0 to 1), and
        whether there is a letter at all, which does not depend on what was learned."""
        counts = self.phrases(texts)
        labels, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return labels, scores, np.fromiter((len(letters(t)) > 0 for t in texts), bool, len(texts))
        cost = counts / self.need
        # Shares of 1 / cost**4: one half for two languages that fit alike.
        weight = np.where(cost > 0, np.maximum(cost, 1e-9), 1.0) ** -4.0
        parsed = counts.sum(axis=1) > 0
        best = np.argmin(cost, axis=1)
        scores[parsed] = (weight[np.arange(len(texts)), best] / weight.sum(axis=1))[parsed]
        for i in np.flatnonzero(parsed):
            labels[i] = self.languages[best[i]]
        return labels, scores, parsed


def learn(docs: DataFrame, training: Column, sample_rows: int = SAMPLE_ROWS) -> tuple[dict[str, str], dict[str, str]]:
    """Sample text and probe text per language, from rows where ``training`` holds.

    Rows are drawn by a hash of their text, about ``sample_rows`` per language whatever the
    table's size, and one of each group of copies. A row gives at most a twentieth of
    ``SAMPLE_CHARS``, from a place in its text that its hash draws, too. Their text is cut to
    ``SAMPLE_CHARS`` and ``PROBE_CHARS``. Only the ``LANGUAGES`` most frequent values of lang are
    learned. Needs no shuffle but one count.
    """
    draw = share("text")
    known = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    sizes = {r.lang: r.n for r in counts.collect()}
    if not sizes:
        return {}, {}
    wanted = F.create_map(*(F.lit(x) for n, c in sizes.items() for x in (n, sample_rows / c)))
    taken = SAMPLE_CHARS // 20
    spare = F.greatest(F.char_length("text") - taken, F.lit(0))
    place = 1 + F.floor(share(F.concat(F.lit("place"), F.col("text"))) * spare).cast("int")
    piece = F.substring("text", place, taken).alias("piece")
    drawn = known.where(draw < wanted[F.col("lang")]).select("lang", piece, draw.alias("draw")).distinct()
    samples: dict[str, str] = {}
    probes: dict[str, str] = {}
    for row in drawn.orderBy("draw", "piece").collect():
        name = row.lang
        # Alternate, so that a language with little text has some of both.
        if len(probes.get(name, "")) < min(PROBE_CHARS, len(samples.get(name, "")) // 2):
            probes[name] = probes.get(name, "") + " " + row.piece
        elif len(samples.get(name, "")) < SAMPLE_CHARS:
            samples[name] = samples.get(name, "") + " " + row.piece
    return samples, probes


@lru_cache(maxsize=2)
def _parser(samples: tuple, probes: tuple) -> Parser:
    """One set of automata per worker process."""
    return Parser(dict(samples), dict(probes))


def predictor(samples: dict[str, str], probes: dict[str, str]):
    """A function of a text column: struct<lang: string, score: double, lettered: boolean>."""
    given = tuple(sorted(samples.items())), tuple(sorted(probes.items()))

    @F.arrow_udf("lang string, score double, lettered boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parser = _parser(*given)
        for batch in batches:
            labels, scores, lettered = [], [], []
            for part in slices(pa.RecordBatch.from_arrays([batch], ["text"]), "text"):
                found, score, some = parser.predict([t or "" for t in part.column(0).to_pylist()])
                labels += found
                scores += score.tolist()
                lettered += some.tolist()
            yield pa.StructArray.from_arrays(
                [pa.array(labels, pa.string()), pa.array(scores, pa.float64()), pa.array(lettered, pa.bool_())],
                ["lang", "score", "lettered"],
            )

    return run


def identify(docs: DataFrame, training: Column, key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score) of every row of ``docs`` (key, text, lang).

    Learns from rows where ``training`` holds and ``lang`` is not null. A text that is null or has
    no letter is ``und`` with score 0, as is every text if there is nothing to learn from. Repeated
    rows are predicted each. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    run = predictor(*learn(docs, training))
    rows = docs.select(F.col(key).alias("key"), run(F.col("text")).alias("found"))
    return rows.select(F.col("key").alias(key), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
