"""Toxicity scores: boosted trees over dense features of a text, with isotonic calibration.

The labelled rows that may be learned from are sampled to a fixed number and dealt into three
parts. From the first, Spark counts in how many texts of either label each word and word beginning
occurs, and the terms that tell the labels apart become a weighted lexicon. On the second, trees
are boosted over the features below; on the third, their scores are calibrated. The model is small
and fixed in size, and scores every text where it was read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adledger.llm.common import share, slices, small_batches
from adledger.storage import stage

SAMPLE_ROWS = 12_000  # labelled rows of either label, at most about
LEXICON_TERMS = 400
LEXICON_Z = 2.6  # standard errors by which a term's log odds ratio has to exceed 0 ...
LEXICON_TOP = 0.5  # ... and the share of the most telling term's
STEMS = (4, 5, 6)  # lengths of the word beginnings in the lexicon
TREES, DEPTH, RATE, BINS = 60, 3, 0.15, 48

_WORD = re.compile(r"[^\W_]+")
# Pronouns and possessives of the second person in the corpus languages.
_SECOND = frozenset(
    "you your yours yourself ya u ur du dich dir dein deine deinen deiner euch euer eure ihr "
    "tu te toi ton ta tes vous votre vos tú ti tuyo tuya usted ustedes vosotros vuestro os".split()
)
_NEAR = 4  # words between a hit and a pronoun
_MIXED = re.compile(r"[^\W\d_]+[0-9@$*!|+]+[^\W\d_]+")
_SPELLED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?!\w)")
_PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "*": None, "+": "t"})

FEATURES = (
    "log_words hits hit_share distinct_hits weight_share top_weight log_weight near_second second_share "
    "upper_share shouted_share exclamation question other_marks mixed_share hidden_hits spelled digit_share"
).split()


class Lexicon:
    """Weights of whole words, and of word beginnings (kept with a star)."""

    def __init__(self, weights: dict[str, float]):
        self.words = {t: w for t, w in weights.items() if not t.endswith("*")}
        self.stems = {t[:-1]: w for t, w in weights.items() if t.endswith("*")}
        self.first = {t[: STEMS[0]] for t in (*self.words, *self.stems)}

    def weight(self, word: str) -> float:
        """The word's largest weight, 0 for a word without one."""
        if word[: STEMS[0]] not in self.first:
            return 0.0
        found = self.words.get(word, 0.0)
        for n in STEMS:
            if len(word) >= n:
                found = max(found, self.stems.get(word[:n], 0.0))
        return found


def features(text: str, lexicon: Lexicon) -> list[float]:
    """FEATURES of one text."""
    low = text.lower()
    words = _WORD.findall(low)
    n, size = max(1, len(words)), max(1, len(text))
    first = lexicon.first
    cut = STEMS[0]
    hits = [(i, w) for i, word in enumerate(words) if word[:cut] in first and (w := lexicon.weight(word)) > 0]
    second = {i for i, word in enumerate(words) if word in _SECOND}
    near = sum(any(i + d in second for d in range(-_NEAR, _NEAR + 1)) for i, _ in hits) if second else 0
    total = sum(w for _, w in hits)
    mixed = _MIXED.findall(low)
    hidden = sum(lexicon.weight(m.translate(_PLAIN)) > 0 for m in mixed)
    spelled = _SPELLED.findall(low)
    hidden += sum(lexicon.weight(re.sub(r"\W|_", "", m)) > 0 for m in spelled)
    raw = text.split()
    upper = sum(map(str.isupper, text)) if text != low else 0
    marks = text.count("!"), text.count("?")
    return [
        math.log1p(len(words)),
        float(len(hits)),
        len(hits) / n,
        float(len({words[i] for i, _ in hits})),
        total / n,
        max((w for _, w in hits), default=0.0),
        math.log1p(total),
        near / n,
        len(second) / n,
        upper / size,
        sum(len(w) > 2 and w.isupper() for w in raw) / n if upper else 0.0,
        marks[0] / size,
        marks[1] / size,
        sum(map(text.count, "*#@$%&")) / size,
        len(mixed) / n,
        float(hidden),
        len(spelled) / n,
        sum(map(text.count, "0123456789")) / size,
    ]


class Tree(NamedTuple):
    """A complete tree by level: node i has the children 2i+1 and 2i+2."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.intp)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (rows[np.arange(len(rows)), self.feature[node]] > self.cut[node])
        return self.value[node - len(self.feature)]


def _grow(binned: np.ndarray, edges: list[np.ndarray], slope: np.ndarray, curve: np.ndarray) -> Tree:
    """One tree for the given first and second derivatives, splits found in histograms."""
    inner = 2**DEPTH - 1
    feature, cut = np.zeros(inner, np.intp), np.full(inner, np.inf)
    node = np.zeros(len(binned), np.intp)
    for at in range(inner):
        rows = np.flatnonzero(node == at)
        best = (1e-6, None)
        for f, cuts in enumerate(edges):
            if not len(cuts) or not len(rows):
                continue
            g = np.cumsum(np.bincount(binned[rows, f], slope[rows], len(cuts) + 1))
            h = np.cumsum(np.bincount(binned[rows, f], curve[rows], len(cuts) + 1))
            gain = g[:-1] ** 2 / (h[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1) - g[-1] ** 2 / (h[-1] + 1)
            gain[(h[:-1] < 0.5) | (h[-1] - h[:-1] < 0.5)] = 0
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), (f, i))
        right = np.zeros(len(rows), bool)
        if best[1]:
            f, i = best[1]
            feature[at], cut[at] = f, edges[f][i]
            right = binned[rows, f] > i
        node[rows] = 2 * at + 1 + right
    leaf = node - inner
    g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, curve, inner + 1)
    return Tree(feature, cut, -RATE * g / (h + 1))


class Model:
    """Boosted trees and their calibration, both fitted with row weights."""

    def __init__(self, rows, labels, weights, held_rows, held_labels, held_weights):
        rows, labels = np.asarray(rows, float).reshape(-1, len(FEATURES)), np.asarray(labels, float)
        weights = np.asarray(weights, float)
        weights = weights / weights.mean() if len(weights) else weights
        share_1 = float(np.average(labels, weights=weights)) if len(labels) else 0.0
        self.base = math.log(max(share_1, 1e-4) / max(1 - share_1, 1e-4))
        self.trees: list[Tree] = []
        if 0 < share_1 < 1:
            edges = []
            for column in rows.T:
                values = np.unique(column)
                middle = (values[1:] + values[:-1]) / 2
                edges.append(middle if len(middle) <= BINS else np.unique(np.quantile(middle, np.linspace(0, 1, BINS))))
            binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, rows.T)])
            score = np.full(len(rows), self.base)
            for _ in range(TREES):
                chance = 1 / (1 + np.exp(-score))
                tree = _grow(binned, edges, weights * (chance - labels), weights * chance * (1 - chance))
                self.trees.append(tree)
                score = score + tree.score(rows)
        self.knots = self._isotonic(self.raw(held_rows), np.asarray(held_labels, float), np.asarray(held_weights, float))

    def raw(self, rows) -> np.ndarray:
        rows = np.asarray(rows, float).reshape(-1, len(FEATURES))
        return self.base + sum((t.score(rows) for t in self.trees), np.zeros(len(rows)))

    @staticmethod
    def _isotonic(raw: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Knots of the non-decreasing fit of labels to scores: neighbours that fall are pooled."""
        at, group = np.unique(raw, return_inverse=True)
        mass = np.bincount(group, weights, len(at))
        mean = np.bincount(group, weights * labels, len(at)) / np.where(mass > 0, mass, 1)
        pools: list[list[float]] = []  # mean, mass, first, last
        for x, m, w in zip(at, mean, mass):
            pools.append([m, w, x, x])
            while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
                m2, w2, _, last = pools.pop()
                m1, w1, *_ = pools[-1]
                pools[-1][0] = (m1 * w1 + m2 * w2) / (w1 + w2)
                pools[-1][1], pools[-1][3] = w1 + w2, last
        xs = [x for p in pools for x in dict.fromkeys(p[2:])]
        ys = [p[0] for p in pools for _ in dict.fromkeys(p[2:])]
        return np.array(xs), np.array(ys)

    def score(self, rows) -> np.ndarray:
        """Scores from 0 to 1. A trace of the raw score keeps the order inside a pool."""
        raw = self.raw(rows)
        plain = 1 / (1 + np.exp(-raw))
        calibrated = np.interp(raw, *self.knots) if len(self.knots[0]) else plain
        return np.clip(0.998 * calibrated + 0.002 * plain, 0.0, 1.0)


def _terms(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) >= 3)
    stems = [
        F.transform(F.filter(words, lambda w, n=n: F.length(w) >= n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*")))
        for n in STEMS
    ]
    return F.array_distinct(F.concat(words, *stems))


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Log odds ratios of the terms that tell toxic texts apart, from (text, toxic).

    Texts that share their three words in a row of least hash count once per label, so that a
    group of near copies cannot make its own words telling.
    """
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 0)
    rows = sample.withColumn("words", words)
    in_a_row = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    texts = rows.withColumn("family", F.array_min(in_a_row)).dropDuplicates(["toxic", "family"])
    totals = texts.agg(F.sum("toxic").alias("pos"), F.count("*").alias("n")).first()
    pos, neg = totals.pos or 0, (totals.n or 0) - (totals.pos or 0)
    if not pos or not neg:
        return {}
    counts = (
        texts.select("toxic", F.explode(_terms(F.col("text"))).alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    )
    ratio = F.log(((F.col("a") + 0.5) / (pos + 1)) / ((F.col("b") + 0.5) / (neg + 1)))
    error = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    telling = counts.where("a >= 3").select("term", ratio.alias("weight"), (ratio / error).alias("z"))
    rows = telling.where(F.col("z") >= LEXICON_Z).orderBy(F.desc("z"), "term").limit(LEXICON_TERMS).collect()
    return {r.term: r.weight for r in rows if r.z >= LEXICON_TOP * rows[0].z}


def _featured(rows: DataFrame, lexicon: dict[str, float]) -> tuple[list, list, list]:
    """Features, labels and weights of the bounded sample, on the driver."""

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Lexicon(lexicon)
        for batch in batches:
            yield pa.array([features(t or "", known) for t in batch.to_pylist()], pa.list_(pa.float64()))

    found = rows.select(run("text").alias("x"), "toxic", "weight").collect()
    return [r.x for r in found], [r.toxic for r in found], [r.weight for r in found]


def learn(docs: DataFrame, labels: DataFrame, training: Column) -> tuple[dict[str, float], Model]:
    """Lexicon and model from labelled rows where ``training`` (over doc_id) holds.

    Rows are drawn by a hash of ``doc_id``, about ``SAMPLE_ROWS`` of either label, whatever the
    size of the tables. Labels other than 0 and 1 are left out; of repeated labels one is taken.
    """
    known = labels.where(training & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = {t: min(1.0, SAMPLE_ROWS / n) for t, n in sizes.items()}
    wanted = F.when(F.col("toxic") == 1, rate.get(1, 0.0)).otherwise(rate.get(0, 0.0))
    drawn = known.where(share("doc_id") < wanted).dropDuplicates(["doc_id"])
    weight = {t: 1 / r for t, r in rate.items()}
    drawn = drawn.withColumn("weight", F.when(F.col("toxic") == 1, weight.get(1, 1.0)).otherwise(weight.get(0, 1.0)))
    # The drawn ids are bounded by SAMPLE_ROWS, so they can go to every task that reads texts.
    sample = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    part = share(F.concat(F.lit("part"), F.col("doc_id").cast("string"))).alias("part")
    sample = stage(sample.select("text", F.col("toxic").cast("long").alias("toxic"), "weight", part), "toxicity-sample")
    lexicon = learn_lexicon(sample.where("part < 0.5").select("text", "toxic"))
    fitting = _featured(sample.where("part >= 0.5 and part < 0.8"), lexicon)
    holding = _featured(sample.where("part >= 0.8"), lexicon)
    return lexicon, Model(*fitting, *holding)


def scorer(lexicon: dict[str, float], model: Model):
    """A function of a text column: the score, a double from 0 to 1."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Lexicon(lexicon)
        for batch in batches:
            scores: list[np.ndarray] = []
            for part in slices(pa.RecordBatch.from_arrays([batch], ["text"]), "text"):
                scores.append(model.score([features(t or "", known) for t in part.column(0).to_pylist()]))
            yield pa.array(np.concatenate([np.zeros(0), *scores]), pa.float64())

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs``.

    A null text counts as empty and is scored, too. Without labelled rows of both labels, every
    score is the share of label 1 among them (0 if there are none). Repeated rows are scored each.
    Columns other than ``doc_id`` and ``text`` are not read.
    """
    small_batches(docs.sparkSession)
    run = scorer(*learn(docs, labels, training))
    scored = docs.select("doc_id", run(F.col("text")).alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
