"""The versioned table: whole commits, conflicts between writers, replays."""

import datetime
import threading

import pytest
from pyspark.sql import functions as F

from adledger.operators import versions

DAYS = [datetime.date(2024, 1, d) for d in range(1, 5)]
SCHEMA = "account_id string, ad_id string, date_start date, clicks bigint"


@pytest.fixture
def rows(spark):
    def build(*records):
        return spark.createDataFrame([(a, b, d if d is None else DAYS[d], n) for a, b, d, n in records], SCHEMA)

    return build


@pytest.fixture
def put(folder, rows):
    def upsert(*records, **options):
        df = rows(*records)
        return versions.upsert(df, folder, schema=df.schema, **options)

    return upsert


def content(spark, path, schema, version=None):
    return sorted(
        ((r.account_id, r.ad_id, r.date_start and DAYS.index(r.date_start), r.clicks) for r in versions.read(spark, path, version, schema).collect()),
        key=str,
    )


def test_versions_are_whole_and_stay_readable(spark, folder, rows, put):
    schema = rows().schema
    assert content(spark, folder, schema) == [] and versions.numbers(spark, folder) == []
    assert put()["status"] == "no_records"
    put(("a", "1", 0, 1), ("a", "2", 1, 1), (None, "x", 0, 5), ("a", "u", None, 7))
    first = versions.read(spark, folder, schema=schema)
    result = put(("a", "1", 0, 9), ("b", "1", 2, 1), (None, "x", 0, 5))
    assert (result["processed"], result["version"], result["attempts"]) == (3, 2, 1)
    old = [("a", "1", 0, 1), ("a", "2", 1, 1), ("a", "u", None, 7), (None, "x", 0, 5)]
    assert content(spark, folder, schema, 1) == sorted(old, key=str) and first.count() == 4
    new = [("a", "1", 0, 9), ("a", "2", 1, 1), ("a", "u", None, 7), ("b", "1", 2, 1), (None, "x", 0, 5), (None, "x", 0, 5)]
    assert content(spark, folder, schema) == sorted(new, key=str)


def test_second_writer_of_a_day_merges_again_or_is_refused(spark, folder, rows, put):
    schema = rows().schema
    put(("a", "1", 0, 1), ("a", "2", 0, 1))
    base = versions.load(spark, folder)
    assert put(("a", "1", 0, 2), base=base)["attempts"] == 1
    with pytest.raises(versions.Conflict):
        put(("a", "2", 0, 3), base=base, retries=0)
    assert content(spark, folder, schema) == [("a", "1", 0, 2), ("a", "2", 0, 1)]
    assert put(("a", "2", 0, 3), base=base)["attempts"] == 2
    assert content(spark, folder, schema) == [("a", "1", 0, 2), ("a", "2", 0, 3)]


def test_writers_of_other_days_do_not_meet(spark, folder, rows, put):
    put(("a", "1", 0, 1), ("a", "1", 1, 1))
    base = versions.load(spark, folder)
    put(("a", "1", 0, 2), ("a", "u", None, 1), base=base)
    assert put(("a", "1", 1, 3), ("b", "u", None, 2), base=base, retries=0)["attempts"] == 1
    want = [("a", "1", 0, 2), ("a", "1", 1, 3), ("a", "u", None, 1), ("b", "u", None, 2)]
    assert content(spark, folder, rows().schema) == want


def test_a_version_number_is_taken_once(spark, folder):
    mine = versions.Version(1, {"2024-01-01": ("x",)}, {"s": 3})
    assert versions._publish(spark, folder, mine)
    assert not versions._publish(spark, folder, versions.Version(1, {"2024-01-01": ("y",)}))
    assert versions.load(spark, folder) == mine
    assert versions.numbers(spark, folder) == [1]


def test_writers_at_the_same_time_lose_nothing(spark, folder, rows, put):
    put(*[("a", str(i), 0, 0) for i in range(8)])
    writers = [threading.Thread(target=put, args=[("a", str(i), 0, 1)], kwargs={"retries": 8}) for i in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert content(spark, folder, rows().schema) == [("a", str(i), 0, int(i < 4)) for i in range(8)]
    assert versions.load(spark, folder).number == 5


def test_replayed_batches_are_known(spark, folder, rows, put):
    put((None, "x", 0, 1), mark=("s", 4))
    assert put((None, "x", 0, 1), mark=("s", 4))["status"] == "replayed"
    base = versions.Version()
    assert put((None, "x", 1, 1), mark=("s", 4), base=base)["version"] == 1
    put((None, "x", 0, 1), mark=("t", 0))
    assert versions.load(spark, folder).marks == {"s": 4, "t": 0}
    assert versions.read(spark, folder, schema=rows().schema).agg(F.count("*")).first()[0] == 2
