"""Operator 13: the patterns against a plain scanner, the models on strings they have not seen."""

import hashlib
import random
import string

import pytest

from adledger.llm import catalogue, secret_scan
from adledger.llm.common import table

SF_DIR = "/root/testdata/sf0.01"  # the smallest with secrets

NAMES = ["password", "passwd", "secret", "token", "apikey", "api_key"]
VALUE = set(string.ascii_letters + string.digits + "+/_.=-")


def plain_spans(text):
    """The contract's base spans, character by character."""
    found, at = [], 0
    while at < len(text):  # assignments
        end = None
        for name in NAMES:
            if all(c.isascii() for c in text[at : at + len(name)]) and text[at : at + len(name)].lower() == name:
                i = at + len(name)
                i += text[i : i + 1] in ("'", '"')
                while text[i : i + 1] == " ":
                    i += 1
                if text[i : i + 1] not in (":", "="):
                    continue
                i += 1
                while text[i : i + 1] == " ":
                    i += 1
                i += text[i : i + 1] in ("'", '"') and text[i : i + 1] != ""
                j = i
                while j < len(text) and text[j] in VALUE:
                    j += 1
                if j > i:
                    end = j
                    if j - i >= 8:
                        found.append((at, 0, j))
                    break
        at = end or at + 1
    for kind, begin, allowed, least in [(1, "AKIA", string.ascii_uppercase + string.digits, 16), (2, "", "0123456789abcdef", 32)]:
        at = 0
        while at < len(text):
            j = at + len(begin)
            if text.startswith(begin, at):
                while j < len(text) and text[j] in allowed:
                    j += 1
            if j > at + len(begin):
                if j - at >= least:
                    found.append((at, kind, j))
                at = j
            else:
                at += 1
    return sorted(found)


ODD = [
    "token=abcdefgh token : 'short' Password = \"hunter2hunter2\" api-key=abcdefgh api_key:abcdefgh APIKEY='a.b/c+d=-_'",
    "token=token=abcdefgh secret::abcdefghi secret: :abcdefgh tokentoken=abcdefgh passwd\"'=abcdefgh passwd'  =  \"abcdefgh",
    "AKIAABCDEFGHIJKL AKIA1234 AKIAAKIAAKIAAKIAX akiaabcdefghijklm xAKIA0123456789AB",
    "0123456789abcdef0123456789abcdef 0123456789abcdef0123456789abcde " + "deadbeef" * 9 + "G",
    "token = 9c8b45435718dcc700c184a7e303cdc64c6a8f7f, ſecret=abcdefgh toKen=abcdefgh sécret=abcdefgh 👍 token=abcdefgh",
    "password\n=abcdefgh password=\nabcdefgh password\t=abcdefgh secret=abc.defgh. token=",
]


@pytest.mark.parametrize("text", ODD)
def test_patterns_equal_a_plain_scanner(text):
    assert secret_scan.base_spans(text) == plain_spans(text)


def test_patterns_equal_a_plain_scanner_on_random_text():
    rng = random.Random(2)
    parts = [*NAMES, "TOKEN", "AKIA", "=", ":", " ", "  ", "'", '"', ".", "abcdef01", "ABCDEF23", "xyz", "ü", "\n", "0123456789abcdef"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 25)))
        assert secret_scan.base_spans(text) == plain_spans(text), text


def digest(spans):
    listed = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in spans)
    return hashlib.sha256(listed.encode()).hexdigest()


def test_query_equals_the_contract(spark):
    docs = {d.doc_id: d.text for d in table(spark, SF_DIR, "documents").collect()}
    found = catalogue.op13_secret_scan(spark, SF_DIR)
    assert found.columns == "doc_id n_assign n_access n_hex base_sha256 spans".split()
    rows = found.collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert any(r.n_assign for r in rows)
    for row in rows:
        spans = plain_spans(docs[row.doc_id] or "")
        kinds = [k for _, k, _ in spans]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(kinds.count(k) for k in range(3))
        assert row.base_sha256 == digest(spans)
        listed = [s for s in row.spans.split(",") if s and not s.startswith("random")]
        assert listed == [f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in spans]


@pytest.fixture(scope="module")
def models(spark):
    return secret_scan.Models(secret_scan.learn(table(spark, SF_DIR, "documents")))


def test_models_tell_random_strings_from_identifiers(models):
    rng = random.Random(7)
    alphabets = [string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_uppercase + string.digits]
    caught = total = 0
    for alphabet in alphabets:
        for size in (24, 28, 31, 40):
            for _ in range(100):
                value = "".join(rng.choices(alphabet, k=size))
                total += 1
                caught += (0, 3, size) in models.spans(value) or any(k == 2 for _, k, _ in models.spans(value))
    assert caught > 0.93 * total
    words = "user account detail page chapter order address number image profile index search result table value name config server release build report".split()
    false = 0
    for _ in range(1000):
        chosen = [rng.choice(words) for _ in range(rng.randint(3, 6))] + [str(rng.randint(1, 2024))]
        style = rng.randrange(4)
        if style == 0:
            name = "_".join(chosen)
        elif style == 1:
            name = "-".join(chosen)
        elif style == 2:
            name = "/".join(chosen).upper()
        else:
            name = chosen[0] + "".join(map(str.capitalize, chosen[1:]))
        false += any(k == 3 for _, k, _ in models.spans(name))
    assert false <= 10


def test_random_spans_are_in_code_points_beside_the_patterns(models):
    value = "Zk3vQ9pLx7Tn2RwBc8Hy5Md4"
    text = f"é👍 see {value} and token={value}"
    assert models.spans(text) == [(7, 3, 31), (36, 0, 66)]
    assert models.spans("Zuschkeitzuendieungeinunglichver 20240131 abcdefghijklmnopqrstuvwxyz") == []


def test_counts_do_not_depend_on_partitions(spark):
    docs = table(spark, SF_DIR, "documents")
    assert (secret_scan.learn(docs.repartition(7)) == secret_scan.learn(docs.coalesce(1))).all()


def test_awkward_rows(spark, awkward, nothing):
    rows = secret_scan.scan(awkward).collect()
    assert [r.doc_id for r in rows] == [d.doc_id for d in awkward.collect()]
    assert [[s.kind for s in r.spans] for r in rows if r.spans] == [["hex"]]  # 9,000 times an a
    assert secret_scan.scan(nothing).collect() == []
    given = spark.createDataFrame([(1, "api_key: 'abcd.efgh'", "x"), (1, "api_key: 'abcd.efgh'", "x")], "doc_id int, text string, spans string")
    assert [[tuple(s) for s in r.spans] for r in secret_scan.scan(given).collect()] == [[("assign", 0, 19)]] * 2
