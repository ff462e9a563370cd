"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from adledger.operators.validate import check, verdict_counts
from adledger.operators.dedup import dedup_stats, keep_latest
from adledger.plans import fixtures as fx
from adledger.plans.catalogue import QUERIES
from adledger.plans.oracles import ORACLES
from adledger.sources import landing
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert difference(spark, duck, name, SF_DIR) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_known_counts(spark):
    """Counts of the adapter that FIXTURES.md states."""
    rows = fx.landing_rows(spark, SF_DIR)
    assert tuple(dedup_stats(rows).first())[:2] == (1000, 397)
    args = (fx.ACCOUNTS, fx.SINCE, fx.UNTIL)
    assert landing.scan_windows(rows, *args).count() == 805
    plain = landing.scan_range(rows, *args)
    assert plain.count() == 698 and keep_latest(plain).count() == 269
    counts = verdict_counts(check(rows)).first()
    assert counts.valid_records == 828
