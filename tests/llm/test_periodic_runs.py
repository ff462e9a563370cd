"""Operator 11: runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from adledger.llm import catalogue, periodic_runs
from adledger.llm.common import table

from .conftest import SF_DIR

EMPTY = hashlib.sha256(b"").hexdigest()


def smallest_period(words):
    border, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = border[k - 1]
        k += words[i] == words[k]
        border[i] = k
    return len(words) - border[-1]


def plain_runs(words):
    """(start, length, period) of all runs, by trying every period."""
    number = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], int)
    out = []
    for q in range(1, len(words) // 3 + 1):
        same = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        first, last = np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])
        for i, j in zip(first.tolist(), last.tolist()):
            length = j - i + q
            if length >= max(24, 3 * q) and smallest_period(words[i : i + length]) == q:
                out.append((i, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_row(doc_id, text):
    """A row of the query, by the contract."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{l},{q}\n" for s, l, q in runs)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest(),
    )


def test_runs_of_random_words_equal_a_plain_search():
    rng = random.Random(5)
    for _ in range(120):
        texts = []
        for _ in range(rng.randint(1, 6)):
            words = []
            for _ in range(rng.randint(0, 8)):
                kinds = rng.choice([1, 2, 3, 50])
                root = [rng.randrange(kinds) for _ in range(rng.randint(1, 20))]
                words += (root * 7)[: rng.randint(1, len(root) * 6)] if rng.random() < 0.6 else root * 1
            texts.append([b"%d" % w for w in words])
        found = [[tuple(r) for r in runs.tolist()] for runs in periodic_runs.find_runs(texts)]
        assert found == [plain_runs(words) for words in texts]


def test_long_repetitions_and_batches_of_many_stretches(monkeypatch):
    monkeypatch.setattr(periodic_runs, "JOINED", 100)
    fibonacci = ["a", "b"]
    for _ in range(13):
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    texts = [list(fibonacci[-1]), ["w"] * 3000, (["x", "y", "z"] * 700)[1:], [str(i) for i in range(500)] * 3, [], ["a"]]
    found = periodic_runs.find_runs([[w.encode() for w in words] for words in texts])
    assert [[tuple(r) for r in runs.tolist()] for runs in found] == [plain_runs(words) for words in texts]
    assert found[1].tolist() == [[0, 3000, 1]] and found[3].tolist() == [[0, 1500, 500]]


def test_stretches_meet_bounds_exactly():
    for n, q, is_run in [(24, 8, True), (23, 1, False), (24, 1, True), (26, 9, False), (27, 9, True)]:
        words = [f"w{i % q}".encode() for i in range(n)]
        assert [r.tolist() for r in periodic_runs.find_runs([words])[0]] == ([[0, n, q]] if is_run else [])


def test_query_equals_the_contract(spark):
    docs = table(spark, SF_DIR, "documents").collect()
    found = catalogue.op11_periodic_runs(spark, SF_DIR)
    assert found.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert {tuple(r) for r in found.collect()} == {plain_row(d.doc_id, d.text) for d in docs}


def test_awkward_rows(awkward, nothing):
    rows = periodic_runs.periodic_runs(periodic_runs.plant_runs(awkward)).collect()
    assert len(rows) == awkward.count()
    expected = [plain_row(d.doc_id, d.text) for d in awkward.collect()]
    for row, want in zip(rows, expected):
        assert (row.doc_id, len(row.runs)) == want[:2]
        assert hashlib.sha256(row.collapsed.encode()).hexdigest() == want[-1]
    assert any(r.runs for r in rows) and any(r.doc_id is None for r in rows)
    assert periodic_runs.periodic_runs(nothing).collect() == []


def test_the_longest_run_is_told_exactly(spark):
    rows = [([(5, 30, 7), (9, 60, 14), (20, 31, 7)],), ([(5, 30, 7), (9, 60, 14)],), ([],)]
    runs = spark.createDataFrame(rows, f"runs {periodic_runs.RUNS}")
    assert [r[0] and tuple(r[0]) for r in runs.select(periodic_runs.longest()).collect()] == [(20, 31, 7), (5, 30, 7), None]
