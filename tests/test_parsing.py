from datetime import date, datetime

import pytest
from hypothesis import given, settings, strategies as st

from adledger.functions.parsing import parse

INTS = {
    "10": 10, " 8 ": 8, "+5": 5, "-7": -7, "007": 7, "\t1\n": 1, " 3 ": 3,
    "9223372036854775807": 2**63 - 1,
    "1.0": None, "": None, " ": None, "1e3": None, "true": None, "0x10": None, "1_000": None,
    "- 1": None, "9223372036854775808": None, "\x001": None, "1\x7f": None, "٣": None,
}
FLOATS = {
    "1e3": 1000.0, "1.": 1.0, ".5": 0.5, " -2.5E-1 ": -0.25, "7": 7.0, "+0": 0.0,
    "inf": float("inf"), "-Infinity": float("-inf"), "+INF": float("inf"),
    "1d": None, "1f": None, "0x1p3": None, "": None, ".": None, "1e": None, "1_0.0": None,
    "true": None, "12,5": None, "in": None, "infinit": None, "1 2": None,
}
DATES = {
    "2024-01-05": date(2024, 1, 5), "2024-1-5": date(2024, 1, 5), "2024-01- 5": date(2024, 1, 5),
    "2024-02-29": date(2024, 2, 29), "0001-01-01": date(1, 1, 1),
    "2024-01": None, "2024-02-30": None, "2024-01-05T00:00:00": None, " 2024-01-05": None,
    "2024-01-05 ": None, "2024-01-05\n": None, "0000-01-01": None, "24-01-05": None,
    "2024-13-01": None, "2024-00-10": None, "2024-01-00": None, "20240105": None, "": None,
    "+2024-01-05": None, "12024-01-05": None,
}


def parsed(spark, kind, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", parse(kind, "t").alias("v")).collect()
    return [r["v"] for r in sorted(out, key=lambda r: r["i"])]


@pytest.mark.parametrize("kind,cases", [("int", INTS), ("float", FLOATS), ("date", DATES)])
def test_known_texts(spark, kind, cases):
    assert dict(zip(cases, parsed(spark, kind, list(cases)))) == cases


def test_nan_and_null(spark):
    values = parsed(spark, "float", ["nan", "-NaN", "+nan", None])
    assert all(v != v for v in values[:3]) and values[3] is None
    assert parsed(spark, "int", [None]) == [None]
    assert parsed(spark, "date", [None]) == [None]


def expected(kind, text):
    """What the language's own parser says."""
    try:
        if kind == "int":
            value = int(text)
            return value if -(2**63) <= value < 2**63 else None
        return float(text) if kind == "float" else datetime.strptime(text, "%Y-%m-%d").date()
    except ValueError:
        return None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("0123456789+-.eE xdnaif\t\n", max_size=7), min_size=200, max_size=400))
def test_numbers_agree_with_the_language(spark, texts):
    for kind in ("int", "float"):
        ours = [repr(v) for v in parsed(spark, kind, texts)]
        assert ours == [repr(expected(kind, t)) for t in texts]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.from_regex(r"\A[0-9]{3,4}-[0-3]?[0-9]?-[ 0-3]?[0-9]{0,2}[ T]?\Z"), min_size=200, max_size=400
    )
)
def test_dates_agree_with_the_language(spark, texts):
    assert parsed(spark, "date", texts) == [expected("date", t) for t in texts]
