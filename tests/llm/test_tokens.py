"""Operators 1, 4 and 5 against the libraries whose results they have to give."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adledger.llm import byte_bpe, catalogue, packing, token_counts

from .conftest import SF_DIR

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "aeT'srevldM  \n\t<|endoftext|>éñßÀ漢字０９!?.,-_ٱ \x1c\x85 ​👍🏽ΣςİÉ́;:"


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(count, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(count)]


def all_code_points(step=400):
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    return ["".join(map(chr, points[i : i + step])) for i in range(0, len(points), step)]


def test_bpe_of_odd_texts(reference):
    words = byte_bpe.vocabulary(RANKS, public_tokenizers.PATTERN)
    texts = random_texts(1500) + all_code_points() + ["abcd" * 900, "a" * 5000, "漢字" * 900, "x" * 1025, " " * 3000 + "x", ""]
    found = words.encode(texts)
    assert found.to_pylist() == [reference.encode_ordinary(t) for t in texts]
    assert words.decode(found).to_pylist() == [t.encode() for t in texts]
    assert words.decode(found.slice(5, 9)).to_pylist() == [t.encode() for t in texts[5:14]]


def test_bpe_merges_long_pieces_in_the_order_of_short_ones(monkeypatch, reference):
    """The heap and the matrix do the same merges, whatever the length."""
    words = byte_bpe.Vocabulary(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(3)
    parts = ["a", "b", "th", "ing", "tion", "er", "é", "漢", "strasse", "q", "zz"]
    pieces = ["".join(rng.choices(parts, k=rng.randint(1, 700))) for _ in range(60)]
    expected = [reference.encode_ordinary(p) for p in pieces]
    assert words.encode(pieces).to_pylist() == expected
    monkeypatch.setattr(byte_bpe, "LONG", 2)
    assert words.encode(pieces).to_pylist() == expected
    monkeypatch.setattr(byte_bpe, "LONG", 1 << 20)
    assert words.encode(pieces).to_pylist() == expected


def test_bpe_of_no_texts_and_null_ids():
    words = byte_bpe.vocabulary(RANKS, public_tokenizers.PATTERN)
    assert words.encode([]).to_pylist() == [] and words.encode(["", ""]).to_pylist() == [[], []]
    ids = pa.array([[100, 200], None, [], [300]], pa.list_(pa.int32()))
    tokens = words.tokens
    assert words.decode(ids).to_pylist() == [tokens[100] + tokens[200], b"", b"", tokens[300]]


def test_bpe_query(spark, documents, reference):
    found = {r.doc_id: r for r in catalogue.op1_byte_bpe(spark, SF_DIR).collect()}
    rows = documents.collect()
    assert len(found) == len(rows)
    for row in rows:
        ids = reference.encode_ordinary(row.text or "")
        got = found[row.doc_id]
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()


def test_bpe_of_awkward_rows(awkward, nothing, reference):
    encoded = byte_bpe.encode(awkward, RANKS, public_tokenizers.PATTERN)
    rows = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    texts = {r.doc_id: r.text or "" for r in awkward.collect()}
    assert len(rows) == awkward.count()
    for row in rows:
        assert row.ids == reference.encode_ordinary(texts[row.doc_id])
        assert bytes(row.decoded) == texts[row.doc_id].encode()
    assert byte_bpe.encode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_counts_of_odd_texts(monkeypatch):
    library = Tokenizer.from_file(BYTES)
    machine = token_counts.Counter(BYTES)
    texts = random_texts(1500) + all_code_points() + ["<|endoftext|>" * 3, "'re're''ll 'll", "ab" * 3000, " " * 2000]
    expected = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert machine.count(texts).tolist() == expected
    # An emptied table gives the same counts.
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    assert machine.count(texts[:300]).tolist() == expected[:300]
    assert machine.count(texts[:300]).tolist() == expected[:300]


def test_counts_of_junk_that_overflows_the_table(monkeypatch):
    """One piece, or many, with more transitions than the table has slots."""
    monkeypatch.setattr(token_counts, "SLOTS", 1 << 14)
    monkeypatch.setattr(token_counts, "MAX_STATES", 2000)
    library = Tokenizer.from_file(BYTES)
    machine = token_counts.Counter(BYTES)
    rng = np.random.default_rng(3)
    junk = lambda n, letters: "".join(rng.choice(list(letters), n))
    for text in (junk(12_000, "abcdefghijklmnopqrstuvwxyz"), junk(40_000, "abcdefghijklmnopqrstuvwxyz"), junk(60_000, "abcdefgXYZ 1,")):
        assert machine.count([text]).tolist() == [len(library.encode(text, add_special_tokens=False).ids)]
        assert machine.merger.filled <= 1 << 13 and len(machine.merger.states) <= 2000


def test_scan_composes_maps():
    rng = np.random.default_rng(0)
    maps = rng.integers(0, 10, (37, 10))
    done = np.arange(10)
    for row, scanned in zip(maps, token_counts.compose(maps)):
        done = row[done]
        assert scanned.tolist() == done.tolist()


def test_counts_query(spark, documents):
    library = Tokenizer.from_file(BYTES)
    found = {r.doc_id: r for r in catalogue.op4_token_counts(spark, SF_DIR).collect()}
    for row in documents.collect():
        n = len(library.encode(row.text or "", add_special_tokens=False).ids)
        assert tuple(found[row.doc_id]) == (row.doc_id, len((row.text or "").encode()), n, n > 1024)


def test_counts_of_awkward_rows(awkward, nothing):
    library = Tokenizer.from_file(BYTES)
    texts = {r.doc_id: r.text or "" for r in awkward.collect()}
    rows = token_counts.count_tokens(awkward, BYTES).collect()
    assert len(rows) == awkward.count()
    for row in rows:
        assert row.n_tokens == len(library.encode(texts[row.doc_id], add_special_tokens=False).ids)
    assert token_counts.count_tokens(nothing, BYTES).count() == 0


def test_word_ids_of_odd_texts():
    library = Tokenizer.from_file(WORDS)
    words = packing.Words(WORDS)
    texts = random_texts(2500) + ["It's. 'S, Don'T", "<|endoftext|>. <|ENDOFTEXT|>", "İ?! ß. Σ;"]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [i.tolist() for i in words.encode([t.encode() for t in texts])] == expected
    assert words.encode([]) == [] and [i.tolist() for i in words.encode([b"", b" \n"])] == [[], []]
    long = ["a" * 3000, "strasse" * 400, "Ü" * 1500 + "x", "12" * 700, "!?" * 900, "x" * 1024, "<|endoftext|>" * 90]
    long += ["".join(random.Random(i).choices(["th", "ing", "É", "7", "'s", ".", "tion", "q"], k=600)) for i in range(20)]
    assert [i.tolist() for i in words.encode([t.encode() for t in long])] == [library.encode(t, add_special_tokens=False).ids for t in long]


def check_packed(rows, texts, length):
    """Pieces follow the law, sequences are gapless and not too long."""
    library = Tokenizer.from_file(WORDS)
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for places in by_sequence.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at and size >= 1
            at += size
        assert at <= length
    for number, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        cuts = [ids[i : i + length] for i in range(0, len(ids), length)]
        expected = [(i, i * length, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for i, c in enumerate(cuts)]
        assert sorted({*by_doc[number]}) == expected
    return len(by_sequence)


def thirds(count, seed, length=4096):
    """Sizes of which three each fill a sequence; best fit in falling order does not find that."""
    rng, out = random.Random(seed), []
    while len(out) < 3 * count:
        a, b = (rng.randint(length // 4 + 1, length // 2 - 1) for _ in range(2))
        if length // 4 < length - a - b < length // 2:
            out += [a, b, length - a - b]
    rng.shuffle(out)
    return out


def test_crossover_and_migration_save_sequences(spark):
    for seed in range(3):
        sizes = thirds(100, seed)
        best_fit = len(packing.Solution(sizes, 4096).fit_all(range(len(sizes))).bins)
        islands = [packing.evolve(sizes, [], i, 4096) for i in (1, 2)]
        migrated = packing.evolve(sizes, islands, 3, 4096)
        assert len({*migrated}) <= min(len({*i}) for i in islands) < best_fit
    pieces = spark.createDataFrame([(n,) for n in sizes], "length long")
    packed = packing.pack(pieces).groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert packed.where("n > 4096").count() == 0 and 100 <= packed.count() < best_fit


def test_equal_pieces_are_spread_and_packed_each(spark):
    """Two thirds of all rows are equal, without an id; no window or number depends on the row."""
    pieces = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN id END AS doc_id", "CASE WHEN id % 3 = 0 THEN 700L ELSE 1L END AS length")
    rows = packing.pack(pieces)
    assert rows.count() == 9000
    used = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert used.where("n <> end or n > 4096").count() == 0
    assert used.count() <= 601  # five of 700 and what fills up


def test_packing_query(spark, documents):
    rows = catalogue.op5_packing(spark, SF_DIR).collect()
    used = check_packed(rows, [(r.doc_id, r.text) for r in documents.collect()], 4096)
    assert used == -(-sum(r.length for r in rows) // 4096)  # as few as can be


def test_packing_of_awkward_rows(awkward, nothing):
    rows = packing.pack_documents(awkward, WORDS, length=64).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in awkward.collect()], 64)
    assert sum(r.doc_id == 5 for r in rows) == 2  # a repeated row is packed twice
    assert packing.pack_documents(nothing, WORDS).count() == 0


def test_packing_in_many_groups(spark, monkeypatch):
    """Several deals of small groups end near the bound, with all pieces once."""
    monkeypatch.setattr(packing, "GROUP", 60)
    rng = random.Random(3)
    pieces = [(i, rng.choice([rng.randint(1, 4096), rng.randint(1, 900), 4096])) for i in range(1500)]
    frame = spark.createDataFrame(pieces, "doc_id long, length long")
    rows = packing.pack(frame).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == pieces
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 4096
    assert len(fill) <= 1.01 * sum(fill.values()) / 4096 + 1


def test_crossover_keeps_every_piece():
    rng = random.Random(5)
    sizes = [rng.randint(1, 100) for _ in range(80)]
    first = packing.Solution(sizes, 100).fit_all(range(80))
    second = packing.Solution(sizes, 100).fit_all(range(80), rng)
    for _ in range(20):
        child = packing.mutate(packing.crossover(first, second, rng), rng)
        assert sorted(i for b in child.bins for i in b) == [*range(80)]
        assert all(sum(sizes[i] for i in b) <= 100 for b in child.bins)
