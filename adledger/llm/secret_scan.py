"""Secrets in texts: fixed patterns, and random strings told from identifiers by Markov models.

Three patterns find what a pattern can: values assigned to telling names, access keys and long
hexadecimal strings. These spans are always reported. They also label samples: what they found are
random strings, all other long words are ordinary ones. Over all documents, tasks count which
character follows which two, for either label; the counts are bounded by the alphabet, whatever the
number of documents. From them come two character Markov models, each order smoothed by the next
lower one. A string of ``LEAST`` characters or more with a letter and a digit, outside of the
patterns' spans, is reported as ``random`` if the log-likelihood ratio of the models is at least
``THRESHOLD``.

A random string may use a larger alphabet than those that the patterns found. Its likelihood is
therefore the mean of the trained model's and of one with equal chances for all characters.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adledger.llm.common import slices, small_batches

LEAST = 20  # characters of a random string
THRESHOLD = 8.0  # nats
LEARNED = 8  # characters of an ordinary word that the models learn from, at least
KINDS = ("assign", "access", "hex", "random")
SPANS = "array<struct<kind: string, start: long, end: long>>"

# Letter case matters in all but the names, and only ASCII letters have two cases there.
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_STRING = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
_WORD = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEARNED},}}")
_MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])", re.S)

# The characters of strings by number; 0 is the edge of a string.
_ALPHABET = "\nABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(_ALPHABET)
_NUMBER = np.zeros(128, np.int64)
_NUMBER[[ord(c) for c in _ALPHABET]] = np.arange(SYMBOLS)
_FIRST = np.array([0, 1, 27, 53, 63])  # of the edge, capitals, small letters, digits, marks
_SHAPE = np.searchsorted(_FIRST, np.arange(SYMBOLS), side="right") - 1

# Labelled samples beside those of the documents: identifiers as programs and addresses have them.
IDENTIFIERS = """
    getElementById addEventListener removeEventListener querySelectorAll createDocumentFragment
    setRequestHeader innerTextContent XMLHttpRequestFactory toLowerCaseString isValidEmailAddress
    application/x-www-form-urlencoded content-security-policy access-control-allow-origin
    max_connections_per_host default_character_set transaction_isolation_level utf8mb4_general_ci
    java/util/concurrent/ThreadPoolExecutor org/apache/commons/lang3/StringUtils node_modules/lib/index2
    MAX_BUFFER_SIZE_BYTES HTTP_STATUS_NOT_FOUND_404 ENABLE_FEATURE_FLAGS_V2 EnterpriseBeanFactory2
    config/environments/production test_user_can_login_twice parse_iso8601_timestamp read_utf8_string
    base64EncodedPayloadLength sha256sum_of_download int32_to_little_endian x86_64-unknown-linux-gnu
    release-candidate-2024-01-31 2024-01-31T00-00-00-backup chapter12_section3_figure4 IMG_20240131_120000
    http/2/protocol/specification python3-development-headers windows-server-2022-datacenter
    customer_address_line_1 invoice_number_2024_000123 product-catalogue-page-17 mp3-player-480x272-screen
    articles/2023/11/winter-recipes-for-two order-2023-0000417 tel-0049-30-1234567 isbn-978-3-16-148410-0
    user-agent-string-parser line-height-and-letter-spacing internationalization neighbourhood2neighbourhood
    src/test/resources/fixtures/case01 Model3Configuration ISO9001Certification CamelCaseWithAVeryLongName
    quickstart-guide-for-beginners frequently-asked-questions why-we-moved-to-version-4 backup20240131
""".split()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of what the patterns find, in order; ends are exclusive."""
    found = [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    return sorted(found)


def _counts(strings: list[str]) -> np.ndarray:
    """How often every character follows every two, flat."""
    joined = "\n\n" + "\n\n".join(strings)
    codes = _NUMBER[np.frombuffer(joined.encode("ascii"), np.uint8)]
    follows = (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:]
    return np.bincount(follows[codes[2:] > 0], minlength=SYMBOLS**3)


def _labelled(text: str) -> tuple[list[str], list[str]]:
    """The text's random strings and its ordinary words."""
    spans = base_spans(text)
    if not spans:
        return [], _WORD.findall(text)
    random, ordinary, at = [], [], 0
    for start, kind, end in spans:
        if kind:
            random.append(text[start:end])
        else:
            random.append(_ASSIGN.match(text, start)[1].replace(".", "\n\n"))
        if start > at:
            ordinary += _WORD.findall(text[at:start])
        at = max(at, end)
    return random, ordinary + _WORD.findall(text[at:])


def learn(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts (label, character before last, last, next) over all documents; label 1 is random.
    What comes to the driver is bounded by the alphabet."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SYMBOLS**3), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                random, ordinary = [], []
                for t in part.column("text").to_pylist():
                    if t:
                        found = _labelled(t)
                        random += found[0]
                        ordinary += found[1]
                total[1] += _counts(random)
                total[0] += _counts(ordinary)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total.ravel()[code])], ["code", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "code long, n long")
    rows = counted.groupBy("code").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(2 * SYMBOLS**3, np.int64)
    total[[r.code for r in rows]] = [r.n for r in rows]
    return total.reshape(2, SYMBOLS, SYMBOLS, SYMBOLS)


def chances(counts: np.ndarray) -> np.ndarray:
    """Chances (before last, last, next) from counts; every order is smoothed by the one below with
    the weight of its number of different continuations, the lowest by equal chances."""
    chance = np.full(SYMBOLS, 1 / (SYMBOLS - 1))
    for order in (counts.sum((0, 1)), counts.sum(0), counts):
        kinds = (order > 0).sum(-1, keepdims=True)
        mass = order.sum(-1, keepdims=True) + kinds
        chance = np.where(mass > 0, (order + kinds * chance) / np.maximum(mass, 1), chance)
    return chance


def shapes(counts: np.ndarray) -> np.ndarray:
    """Chances of a coarser chain, for characters that the counts hardly tell about: the kind of
    character (capital, small letter, digit, mark) by the two before, then the one of that kind."""
    coarse = counts
    for axis in range(3):
        coarse = np.add.reduceat(coarse, _FIRST, axis=axis)
    coarse = coarse[..., 1:] + 0.5
    coarse /= coarse.sum(-1, keepdims=True)
    single = counts.sum((0, 1)) + 1.0
    single /= np.add.reduceat(single, _FIRST)[_SHAPE]
    chance = np.zeros((len(_FIRST), len(_FIRST), SYMBOLS))
    chance[..., 1:] = coarse[..., _SHAPE[1:] - 1] * single[1:]
    return chance[_SHAPE][:, _SHAPE]


class Models:
    """Log chances of either label, flat. Ordinary strings follow the documents' words or the shapes
    of ``IDENTIFIERS``, one as likely as the other at every character."""

    def __init__(self, counts: np.ndarray):
        known = shapes(_counts(IDENTIFIERS).reshape(counts[0].shape))
        ordinary = (chances(counts[0]) + known) / 2
        self.ordinary, self.random = (
            np.log(np.maximum(c, 1e-30)).astype(np.float32).ravel() for c in (ordinary, chances(counts[1]))
        )

    def ratio(self, string: str) -> float:
        """Log-likelihood ratio: how much likelier the string is as a random one."""
        codes = _NUMBER[np.frombuffer(f"\n\n{string}".encode("ascii"), np.uint8)]
        follows = (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:]
        equal = -len(string) * math.log(SYMBOLS - 1)
        random = np.logaddexp(float(self.random[follows].sum()), equal) - math.log(2)
        return float(random - self.ordinary[follows].sum())

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, number of the kind, end) of all spans, in order."""
        found = base_spans(text)
        known = list(found)
        for m in _STRING.finditer(text):
            start, end = m.span()
            if _MIXED.match(m[0]) and not any(s < end and start < e for s, _, e in known):
                if self.ratio(m[0]) >= THRESHOLD:
                    found.append((start, 3, end))
        return sorted(found)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, spans) of every row: kind, start and end (exclusive) in code points, by start, then by
    kind as in ``KINDS``.

    Patterns match from the left without overlaps, each kind on its own. A match that is too short
    still ends where it ends. A null or empty text has no spans. Repeated rows and null keys get a
    row each; rows weigh in the models as often as they occur. An empty table gives no rows, and
    without any document the models know ``IDENTIFIERS`` only. Other columns are not read.
    """
    counts = learn(docs, text)

    @F.arrow_udf(SPANS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        models = Models(counts)
        kinds = np.array(KINDS)
        for batch in batches:
            ends, rows = [0], []
            for part in slices(pa.RecordBatch.from_arrays([batch], ["text"]), "text"):
                for t in part.column(0).to_pylist():
                    rows += models.spans(t) if t else []
                    ends.append(len(rows))
            start, kind, end = np.array(rows, np.int64).reshape(-1, 3).T
            columns = [pa.array(kinds[kind], pa.string()), pa.array(start), pa.array(end)]
            spans = pa.StructArray.from_arrays(columns, ["kind", "start", "end"])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)

    return docs.select(F.col(key).alias("key"), run(F.col(text)).alias("spans")).withColumnRenamed("key", key)
