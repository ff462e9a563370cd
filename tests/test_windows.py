import random
from datetime import date, timedelta

import pytest
from conftest import tree_of
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from adledger.operators.dedup import keep_latest
from adledger.sources import landing, windows

D = date.fromisoformat


def plan(spark, since, until, days=7):
    return sorted((str(r.since), str(r.until)) for r in windows.chunk_plan(spark, since, until, days).collect())


@pytest.mark.parametrize(
    "since,until,want",
    [
        ("2024-01-01", "2024-01-01", [("2024-01-01", "2024-01-01")]),
        ("2024-01-01", "2024-01-08", [("2024-01-01", "2024-01-07"), ("2024-01-07", "2024-01-08")]),
        ("2024-01-01", "2024-01-07", [("2024-01-01", "2024-01-07"), ("2024-01-07", "2024-01-07")]),
        ("2024-01-02", "2024-01-01", []),
    ],
)
def test_plan(spark, since, until, want):
    assert plan(spark, since, until) == want


def test_one_day_windows_are_refused(spark):
    with pytest.raises(ValueError, match="at least 2"):
        windows.chunk_plan(spark, "2024-01-01", "2024-01-02", 1)


def test_account_plan_is_accounts_times_windows(spark):
    accounts = spark.createDataFrame([("a",), ("b",)], "account_id string")
    got = windows.account_plan(accounts, "2024-01-01", "2024-01-20").collect()
    assert len(got) == 8
    assert {str(r.since)[8:] for r in got} == {"01", "07", "13", "19"}


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 40), st.integers(2, 9))
def test_windows_of_a_day_match_the_plan(spark, length, days):
    first = D("2024-02-20")
    last = first + timedelta(days=length)
    expected = {
        (str(r.since), str(r.until), str(r.since + timedelta(days=i)))
        for r in windows.chunk_plan(spark, first, last, days).collect()
        for i in range((r.until - r.since).days + 1)
    }
    calendar = spark.range(length + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"))
    got = calendar.select("d", F.inline(windows.windows_of_day(F.col("d"), first, last, days)))
    assert sorted((str(r.since), str(r.until), str(r.d)) for r in got.collect()) == sorted(expected)


@pytest.mark.parametrize("days", [2, 3, 7, 40])
def test_window_scan_deduplicates_to_the_plain_scan(spark, days):
    rows = spark.range(3000).select(
        F.col("id").alias("_seq"),
        (F.col("id") % 3).cast("string").alias("account_id"),
        (F.col("id") % 41).cast("string").alias("ad_id"),
        F.date_format(F.date_add(F.lit(D("2024-01-01")), (F.col("id") % 31).cast("int")), "yyyy-MM-dd").alias("date_start"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("2024-02-0"), F.col("id") % 3 + 1)).alias("date_stop"),
    )
    args = (["0", "1"], "2024-01-03", "2024-01-20")
    by_window = landing.scan_windows(rows, *args, days)
    plain = landing.scan_range(rows, *args)
    assert (by_window.count() > plain.count()) == (days < 18)
    kept = keep_latest(by_window).select("_seq").collect()
    assert sorted(kept) == sorted(keep_latest(plain).select("_seq").collect())


def test_rows_meet_the_windows_of_any_plan(spark):
    """Windows of many lengths, overlapping, apart and empty, against a plain search."""
    rng = random.Random(3)
    first = date(2024, 1, 1)
    day = lambda n: first + timedelta(days=n)
    plan = [(str(rng.randrange(4)), day(a := rng.randrange(-5, 60)), day(a + rng.randrange(-2, 40))) for _ in range(60)]
    rows = [(i, str(rng.randrange(5)) if i % 3 else "0", rng.choice([str(day(rng.randrange(60))), "2024-1-5", "n/a", None])) for i in range(600)]
    frame = spark.createDataFrame(rows, "_seq long, account_id string, date_start string")
    wanted = spark.createDataFrame(plan, "account_id string, since date, until date")
    found = landing.scan_plan(frame, wanted, bin_days=7, deal=3)
    got = sorted((r._seq, r.since, r.until) for r in found.collect())
    days = {"2024-1-5": day(4), "n/a": None, None: None}
    assert got == sorted(
        (n, s, u) for n, a, d in rows for b, s, u in plan
        if a == b and (x := days.get(d) if d in days else D(d)) and s <= x <= u
    )
    tree = tree_of(found)
    assert "NestedLoop" not in tree and "Cartesian" not in tree
