"""Token counts by compiled finite-state machines, without making the tokens.

Two deterministic transducers do the work.

*Splitter.* The pattern that cuts a text into pieces before the merges is a machine of ten states
over classes of characters. Its transitions emit cuts: before the character just read, or before
the one before it, where only the next character decides. A batch of texts is laid out as chunks
of equal length. Every chunk first computes its *state map*, the state it ends in for each state
it may begin in; the maps are composed by a parallel prefix scan, which gives every chunk its
true first state; then all chunks emit their cuts side by side.

*Merger.* Inside a piece the merges form a machine over bytes whose transitions carry the change
in the number of tokens, so the sum along a piece is its count. A state holds every position from
which a token may still reach past the end, with the last token before it and the count there;
the root has the empty beginning only. On a byte, exactly one of these positions ends a token
that agrees with the token before it (the two stay apart when merged by rank), and so gives the
last token and the count of the longer text. States are compiled when data first needs them, and
before the table would pass ``MAX_STATES``, or half of its ``SLOTS``, it is emptied but for the
states that lanes are in, so a worker's memory is bounded, whatever the length of a text or a piece.

Special strings in a text are cut out beforehand and count as one token each, which is the
library's default for them.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from adledger.llm.common import slices, small_batches

MAX_STATES = 300_000
SLOTS = 1 << 21  # of the transition table; half of them stay empty
CHUNK = 512  # characters of a splitter chunk
LANE = 1024  # bytes of a merger lane, at least

# Classes of characters. The letters of the contractions have classes of their own.
_ONE, _R, _V, _E, _L, LETTER, NUMBER, SPACE, WHITE, QUOTE, OTHER, END = range(12)
_N_CLASSES = 12
# States of the splitter: a piece is about to begin, runs of each kind, a quotation mark that
# begins a piece, and one with the first letter of a long contraction.
_NEW, _LET, _NUM, _OTH, _SP, _WS, _QU, _QR, _QV, _QL = range(10)
_N_STATES = 10
_HERE, _BEFORE = 1, 2  # emitted cuts: before this character, before the previous one


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """The class of every code point."""
    classes = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
        for match in regex.finditer(pattern, every):
            a, b = ord(match[0][0]), ord(match[0][-1])
            if b - a + 1 == len(match[0]):
                classes[a : b + 1] = kind
            else:
                classes[[ord(c) for c in match[0]]] = kind
    # The pattern's white space is Unicode's property, without the separators U+001C to U+001F.
    classes[0x1C:0x20] = OTHER
    for kind, chars in ((_ONE, "stmd"), (_R, "r"), (_V, "v"), (_E, "e"), (_L, "l"), (SPACE, " "), (QUOTE, "'")):
        classes[[ord(c) for c in chars]] = kind
    return classes


@lru_cache(maxsize=1)
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emitted cuts for (class, state)."""
    letters = {_ONE, _R, _V, _E, _L, LETTER}
    begin = {**dict.fromkeys(letters, _LET), NUMBER: _NUM, OTHER: _OTH, QUOTE: _QU, SPACE: _SP, WHITE: _WS}
    run = {_LET: letters, _NUM: {NUMBER}, _OTH: {OTHER, QUOTE}}
    after_quote = {_ONE: _NEW, _R: _QR, _V: _QV, _L: _QL}
    long_ends = {_QR: _E, _QV: _E, _QL: _L}

    def step(state: int, kind: int) -> tuple[int, int]:
        if state in long_ends:
            if kind == long_ends[state]:
                return _NEW, 0
            after, cut = step(_LET, kind)  # the mark stands alone, its letter begins a word
            return after, cut | _BEFORE
        if kind == END:
            return _NEW, 0
        if state in run:
            return (state, 0) if kind in run[state] else (begin[kind], _HERE)
        if state == _QU:
            if kind in after_quote:
                return after_quote[kind], 0
            return (_OTH, 0) if kind in run[_OTH] else (begin[kind], _HERE)
        if state in (_SP, _WS):
            if kind in (SPACE, WHITE):
                return begin[kind], 0
            if state == _WS:
                return begin[kind], _HERE | _BEFORE
            return (_OTH if kind == QUOTE else begin[kind]), _BEFORE
        return begin[kind], _HERE

    after = np.zeros((_N_CLASSES, _N_STATES), np.uint8)
    cuts = np.zeros((_N_CLASSES, _N_STATES), np.uint8)
    for kind in range(_N_CLASSES):
        for state in range(_N_STATES):
            after[kind, state], cuts[kind, state] = step(state, kind)
    return after, cuts


def compose(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan: row i becomes the map of chunks 0 to i, in log2(n) steps."""
    maps, reach = maps.copy(), 1
    while reach < len(maps):
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
        reach *= 2
    return maps


def cuts_of(classes: np.ndarray) -> np.ndarray:
    """True where a piece begins. Segments end with the class END; so does the array."""
    after, emitted = splitter()
    n = len(classes)
    chunks = -(-n // CHUNK)
    grid = np.full(chunks * CHUNK, END, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
    flat = after.ravel()
    maps = np.tile(np.arange(_N_STATES, dtype=np.intp), (chunks, 1))
    for column in grid:
        maps = flat[column[:, None] * np.intp(_N_STATES) + maps]
    state = np.zeros(chunks, np.intp)  # the text begins in state _NEW, which is 0
    state[1:] = compose(maps)[:-1, _NEW]
    out = np.empty_like(grid)
    for i, column in enumerate(grid):
        at = column * np.intp(_N_STATES) + state
        out[i] = emitted.ravel()[at]
        state = flat[at]
    out = out.T.ravel()[:n]
    begins = (out & _HERE) > 0
    begins[:-1] |= (out[1:] & _BEFORE) > 0
    return begins


class Merger:
    """The byte machine of one vocabulary, compiled as far as data has needed it."""

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]], token_bytes: list[bytes]):
        """``merges``: pair of ids to (rank, merged id)."""
        self.merges, self.token_bytes = merges, token_bytes
        self.single = {b: i for i, t in enumerate(token_bytes) if t and len(t) == 1 for b in t}
        self.children: list[dict[int, int]] = [{}]  # trie of all tokens
        self.token_at: list[int] = [-1]
        for token, raw in enumerate(token_bytes):
            node = 0
            for b in raw or b"":
                if b not in self.children[node]:
                    self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                node = self.children[node][b]
            if raw:
                self.token_at[node] = token
        self.apart: dict[int, bool] = {}
        # Transitions by state * 256 + byte, in an open-addressing table.
        self.cells = np.full(SLOTS, -1, np.int64)
        self.after = np.zeros(SLOTS, np.int32)
        self.emits = np.zeros(SLOTS, np.int16)
        self.clear()

    def clear(self) -> None:
        root = array("i", (0, -1, 0)).tobytes()
        self.states, self.number = [root], {root: 0}
        self.cells.fill(-1)
        self.filled = 0

    def merge(self, ids: list[int]) -> list[int]:
        """Plain merging by rank, leftmost first."""
        while len(ids) > 1:
            best = min(
                ((self.merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges), default=None
            )
            if best is None:
                break
            i = best[1]
            ids[i : i + 2] = [self.merges[ids[i], ids[i + 1]][1]]
        return ids

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the two tokens' joint text merges to just these two."""
        key = left << 32 | right
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) >= 8 * MAX_STATES:
                self.apart.clear()
            raw = self.token_bytes[left] + self.token_bytes[right]
            known = self.apart[key] = self.merge([self.single[b] for b in raw]) == [left, right]
        return known

    def compile(self, state: int, byte: int) -> None:
        """Add the transition from ``state`` on ``byte`` to the table."""
        entries = array("i", self.states[state])
        kept, ends = [], None
        for node, last, count in zip(entries[::3], entries[1::3], entries[2::3]):
            node = self.children[node].get(byte)
            if node is None:
                continue
            token = self.token_at[node]
            if ends is None and token >= 0 and (
                self.merge([self.single[b] for b in self.token_bytes[token]]) == [token]
                if last < 0
                else self.stay_apart(last, token)
            ):
                ends = token, count + 1
            if self.children[node]:
                kept += node, last, count
        token, change = ends
        kept[2::3] = [count - change for count in kept[2::3]]
        key = array("i", (*kept, 0, token, 0)).tobytes()
        number = self.add(key)
        cell = state << 8 | byte
        slot = int(self.find(np.array([cell]))[0])
        self.cells[slot], self.after[slot], self.emits[slot] = cell, number, change
        self.filled += 1

    def add(self, key: bytes) -> int:
        """The number of a state."""
        number = self.number.setdefault(key, len(self.states))
        if number == len(self.states):
            self.states.append(key)
        return number

    def empty(self, state: np.ndarray) -> np.ndarray:
        """Forget all but the given states; returns their new numbers."""
        kept, place = np.unique(state, return_inverse=True)
        keys = [self.states[s] for s in kept.tolist()]
        self.clear()
        return np.array([self.add(key) for key in keys], np.int64)[place]

    def find(self, cell: np.ndarray) -> np.ndarray:
        """The slot of every transition, or the empty one where it belongs."""
        slot = (cell * 0x9E3779B1 >> 7) & (SLOTS - 1)
        held = self.cells[slot]
        other = np.flatnonzero((held != cell) & (held >= 0))
        while len(other):
            slot[other] = (slot[other] + 1) & (SLOTS - 1)
            held = self.cells[slot[other]]
            other = other[(held != cell[other]) & (held >= 0)]
        return slot

    def run(self, raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Tokens emitted at every byte; pieces begin where ``begins`` is true, the first at 0."""
        out = np.zeros(len(raw), np.int16)
        if not len(raw):
            return out
        # A lane begins with the first piece after every LANE bytes, or more if the lanes would be so
        # many that one step could fill the table.
        lane = max(LANE, len(raw) // max(1, min(MAX_STATES, SLOTS // 2) // 4))
        at = np.flatnonzero(begins)
        lanes = at[np.unique(np.searchsorted(at, np.arange(0, at[-1] + 1, lane)))]
        lengths = np.diff(np.append(lanes, len(raw)))
        order = np.argsort(-lengths, kind="stable")
        lanes, lengths = lanes[order], lengths[order]
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        state = np.zeros(len(lanes), np.int64)
        for step, n in enumerate(active.tolist()):
            place = lanes[:n] + step
            state = state[:n]
            state[begins[place]] = 0
            cell = state << 8 | raw[place]
            slot = self.find(cell)
            missing = np.flatnonzero(self.cells[slot] < 0)
            if len(missing):
                if len(self.states) + len(missing) > MAX_STATES or self.filled + len(missing) > SLOTS // 2:
                    state = self.empty(state)
                    cell = state << 8 | raw[place]
                    slot = self.find(cell)
                    missing = np.arange(n)
                for c in {*cell[missing].tolist()}:
                    self.compile(c >> 8, c & 0xFF)
                slot[missing] = self.find(cell[missing])
            out[place] = self.emits[slot]
            state = self.after[slot].astype(np.int64)
        return out


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    """Counts tokens of texts for a byte-level tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, vocabulary = _byte_letters(), spec["model"]["vocab"]
        special = [t["content"] for t in spec["added_tokens"]]
        token_bytes = [b""] * (max(vocabulary.values()) + 1)
        for text, number in vocabulary.items():
            if text not in special:
                token_bytes[number] = bytes(letters[c] for c in text)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        merges = {
            (vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        self.merger = Merger(merges, token_bytes)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of every text."""
        parts, owner = [], []
        extra = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            cut = self.special.split(text) if self.special else [text]
            extra[i] = len(cut) - 1
            for part in cut:
                if part:
                    parts.append(part)
                    owner.append(i)
        if not parts:
            return extra
        joined = "".join(parts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        place = np.arange(len(points)) + np.repeat(np.arange(len(parts)), lengths)
        classes = np.full(len(points) + len(parts), END, np.uint8)
        classes[place] = character_classes()[points]
        begins = cuts_of(classes)[place]
        raw = np.frombuffer(joined.encode(), np.uint8)
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        first = np.cumsum(width) - width
        byte_begins = np.zeros(len(raw), bool)
        byte_begins[first[begins]] = True
        emitted = self.merger.run(raw, byte_begins)
        starts = first[np.cumsum(lengths) - lengths]
        np.add.at(extra, owner, np.add.reduceat(emitted, starts, dtype=np.int64))
        return extra


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One machine per worker process."""
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row.

    ``tokenizer`` is the path of the vocabulary file on the executors. A null text counts as empty
    and has no tokens; a null key stays. Rows that repeat are counted each. Other columns are not
    read. Nothing is shuffled: every batch is counted where it was read.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                counts = machine.count([t or "" for t in part.column("text").to_pylist()])
                sizes = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("key"), sizes, pa.array(counts)], ["key", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, n_bytes long, n_tokens long"
    return rows.mapInArrow(run, schema).select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
