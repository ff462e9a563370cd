import os
from datetime import date, timedelta

import pytest
from conftest import plan_of, tree_of
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from adledger import registry
from adledger.operators import upsert as U
from adledger.operators.validate import check, valid_rows


def typed(spark, rows):
    """(ad_id, date_start, account_id, date_stop, clicks, ad_name) as table rows."""
    schema = "ad_id string, date_start string, account_id string, date_stop string, clicks long, ad_name string"
    df = spark.createDataFrame(rows, schema)
    return registry.conform(df.withColumns({c: F.to_date(c) for c in ("date_start", "date_stop")}))


def content(spark, path):
    columns = ("ad_id", "date_start", "account_id", "date_stop", "clicks", "ad_name")
    rows = U.read_table(spark, path).select(*columns).collect()
    return sorted(tuple("" if v is None else str(v) for v in r) for r in rows)


def row(ad, day, account="9", stop=None, clicks=None, name=None):
    return (ad, day, account, stop, clicks, name)


DAY1, DAY2, DAY3 = "2024-01-01", "2024-01-02", "2024-01-03"


def test_update_insert_and_keep(spark, folder):
    old = [row("1", DAY1, clicks=1, name="old"), row("2", DAY1, clicks=2), row("3", DAY2, clicks=3)]
    U.append_rows(typed(spark, old), folder)
    new = [row("1", DAY1, clicks=10), row("4", DAY3, clicks=4)]
    result = U.upsert(typed(spark, new), folder)
    assert result == {"processed": 2, "rows_affected": 2, "status": "success"}
    # The matched row is replaced as a whole: its name becomes null.
    assert content(spark, folder) == [
        ("1", DAY1, "9", "", "10", ""),
        ("2", DAY1, "9", "", "2", ""),
        ("3", DAY2, "9", "", "3", ""),
        ("4", DAY3, "9", "", "4", ""),
    ]
    again = content(spark, folder)
    U.upsert(typed(spark, new), folder)
    assert content(spark, folder) == again


def test_rows_with_a_missing_key_are_always_inserted(spark, folder):
    rows = [row(None, DAY1, clicks=1), row("1", None, clicks=2), row("1", DAY1, None, clicks=3)]
    U.upsert(typed(spark, rows), folder)
    U.upsert(typed(spark, rows), folder)
    U.upsert(typed(spark, [row("5", DAY1)]), folder)
    assert len(content(spark, folder)) == 7


def test_untouched_days_are_not_rewritten(spark, folder):
    U.append_rows(typed(spark, [row("1", DAY1), row("1", DAY2)]), folder)

    def files(day):
        rows = spark.read.parquet(folder).filter(F.col("date_start") == day)
        return {r[0] for r in rows.select("_metadata.file_path").distinct().collect()}

    before = files(DAY1), files(DAY2)
    U.upsert(typed(spark, [row("2", DAY2)]), folder)
    assert files(DAY1) == before[0] and not files(DAY2) & before[1]


def test_repeated_source_keys_fail_and_change_nothing(spark, folder):
    U.append_rows(typed(spark, [row("1", DAY1, clicks=1)]), folder)
    with pytest.raises(ValueError, match="several rows for one key"):
        U.upsert(typed(spark, [row("1", DAY1, clicks=2), row("1", DAY1, clicks=3)]), folder)
    assert content(spark, folder) == [("1", DAY1, "9", "", "1", "")]


def test_empty_source(spark, folder):
    U.append_rows(typed(spark, [row("1", DAY1)]), folder)
    before = content(spark, folder)
    assert U.upsert(typed(spark, []), folder) == {"processed": 0, "status": "no_records"}
    assert content(spark, folder) == before


def test_unknown_columns_are_dropped_at_the_table(spark, folder):
    U.upsert(typed(spark, [row("1", DAY1)]).withColumn("purchase_roas", F.lit(1)), folder)
    assert "purchase_roas" not in spark.read.parquet(folder).columns


def test_days_in_between_are_left_alone(spark, folder):
    """Only the touched days are rewritten, however far apart and however many."""
    U.append_rows(typed(spark, [row("1", DAY1), row("1", DAY2, clicks=5), row("1", DAY3)]), folder)
    files = lambda day: sorted(os.listdir(f"{folder}/date_start={day}"))
    before = files(DAY2)
    U.upsert(typed(spark, [row("1", DAY1, clicks=7), row("1", DAY3, clicks=8)]), folder)
    assert [r[4] for r in content(spark, folder)] == ["7", "5", "8"] and files(DAY2) == before

    first = date(2000, 1, 1)
    touched = [first + timedelta(days=2 * i) for i in range(4500)]
    days = spark.range(9000).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date_start"))
    got = [r[0] for r in days.filter(U._on_days(touched)).collect()]
    assert sorted(got) == touched


def test_agrees_with_a_dictionary(spark, folder):
    import random

    rng = random.Random(5)
    table = {}
    for _ in range(3):
        keys = {(str(rng.randrange(6)), f"2024-01-0{rng.randrange(1, 4)}", str(rng.randrange(2))) for _ in range(15)}
        batch = [(a, d, acc, None, rng.randrange(1000), None) for a, d, acc in sorted(keys)]
        table.update({r[:3]: str(r[4]) for r in batch})
        U.upsert(typed(spark, batch), folder)
        assert {r[:3]: r[4] for r in content(spark, folder)} == table


def test_update_only(spark, folder):
    old = [row("1", DAY1, "9", DAY2, 1, "x"), row("2", DAY1, "9", None, 2), row("3", DAY2, "9", DAY2, 3)]
    U.append_rows(typed(spark, old), folder)
    new = [row("1", DAY1, "8", DAY2, 10), row("2", DAY1, "9", None, 20), row("3", DAY2, "9", DAY3, 30)]
    assert U.update_only(typed(spark, new), folder) == 3
    assert content(spark, folder) == [
        ("1", DAY1, "8", DAY2, "10", ""),
        ("2", DAY1, "9", "", "2", ""),
        ("3", DAY2, "9", DAY2, "3", ""),
    ]


def test_merge_counts(spark):
    target = typed(spark, [row("1", DAY1), row(None, DAY1)])
    src = typed(spark, [row("1", DAY1), row("2", DAY1), row(None, DAY1)])
    assert U.merge_counts(target, src).first().asDict() == {
        "processed": 3, "updated": 1, "inserted": 2, "rows_affected": 3
    }


def test_split_known(spark):
    existing = typed(spark, [row("1", DAY1, stop=DAY2), row("2", DAY1, stop=DAY2)])
    text = "date_start string, date_stop string, ad_id string"
    new = spark.createDataFrame([(DAY1, DAY2, "1"), (DAY1, DAY3, "2"), (DAY1, None, "1"), ("2024-1-1", DAY2, "1")], text)
    updates, inserts = U.split_known(new, existing)
    assert [tuple(r) for r in updates.collect()] == [(DAY1, DAY2, "1")]
    assert inserts.count() == 3


def test_existing_records_tests_columns_apart(spark):
    target = typed(spark, [row("1", DAY1, stop=DAY1), row("1", DAY2, stop=DAY2), row("2", DAY1, stop=DAY2), row("3", DAY1, stop=DAY1)])
    days = [F.lit(DAY1).cast("date"), F.lit(DAY2).cast("date")]
    ads = spark.createDataFrame([("1",), ("2",), ("2",)], "x string")
    got = U.existing_records(target, days, days, ads)
    assert got.columns == ["date_start", "date_stop", "ad_id"] and got.count() == 3
    assert U.existing_records(target, days[:1], days, ["1", "3"]).count() == 2


def test_append_with_rejects(spark, folder, rows_of):
    records = [
        {"ad_id": "1", "date_start": DAY1, "clicks": "5"},
        {"ad_id": "2", "date_start": DAY1, "clicks": "x"},
        {"ad_id": "3", "date_start": DAY1, "actions": [{"action_type": "a", "value": "z"}]},
    ]
    rejects = U.append_with_rejects(rows_of(records), folder).collect()
    assert {r["_order"]: r["issues"][0]["code"] for r in rejects} == {1: "bad_value", 2: "transformation_failed"}
    assert [r[0] for r in content(spark, folder)] == ["1"]


def test_overwrite_then_append(spark, folder):
    U.append_rows(typed(spark, [row("0", DAY3)]), folder)
    U.overwrite_then_append(typed(spark, [row("1", DAY1)]), [typed(spark, [row("2", DAY1)])], folder)
    assert [r[0] for r in content(spark, folder)] == ["1", "2"]


def test_clone_and_register(spark, folder):
    U.append_rows(typed(spark, [row("1", DAY1), row("1", None)]), folder)
    clone = U.clone_schema(spark, U.read_table(spark, folder), folder + "-clone")
    assert clone.count() == 0 and clone.schema.names == registry.schema_for("insights").names
    U.register_table(spark, "raw_ads_test.ads_one", folder)
    assert spark.table("raw_ads_test.ads_one").count() == 2
    U.append_rows(typed(spark, [row("1", DAY2)]), folder)
    U.register_table(spark, "raw_ads_test.ads_one", folder)
    assert spark.table("raw_ads_test.ads_one").count() == 3
    spark.sql("DROP TABLE raw_ads_test.ads_one")


def test_route_table():
    assert U.route_table("daily") == "ads.daily"
    assert U.route_table("a.b") == "a.b"


def test_merge_into_needs_row_level_operations(spark, folder):
    U.append_rows(typed(spark, [row("1", DAY1)]), folder)
    U.register_table(spark, "ads_two", folder)
    with pytest.raises(UnsupportedOperationException, match="MERGE INTO"):
        U.merge_into(typed(spark, [row("1", DAY1)]), "ads_two")
    spark.sql("DROP TABLE ads_two")


def test_staged_counts_read_no_columns(spark, rows_of):
    staged = U.stage_checked(check(rows_of([{"clicks": "1"}, {"clicks": "x"}])), registry.schema_for("insights"))
    counts = staged.groupBy("_ok").count()
    assert "ReadSchema: struct<>" in plan_of(counts)
    assert {r["_ok"]: r["count"] for r in counts.collect()} == {True: 1, False: 1}
    assert valid_rows(check(rows_of([{"clicks": "1"}]))).count() == 1


def test_old_rows_are_read_from_touched_days_only(spark, folder):
    U.append_rows(typed(spark, [row("1", DAY1), row("1", DAY2)]), folder)
    days = U._source_facts(typed(spark, [row("2", DAY2)]), registry.UPSERT_KEYS)[1]
    old = U.read_table(spark, folder).filter(U._on_days(days))
    pruned = plan_of(old).split("PartitionFilters: ")[1].split("\n")[0]
    assert "date_start" in pruned
    assert "Exchange" not in tree_of(old)


def test_a_hot_day_is_split_over_files(spark, folder):
    name = F.concat(*(F.md5((F.col("id") + i).cast("string")) for i in range(4)))
    rows = spark.range(0, 30000, 1, 8).select(
        F.col("id").cast("string").alias("ad_id"),
        F.lit("9").alias("account_id"),
        name.alias("ad_name"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.when(F.col("id") % 3 == 0, 0).otherwise((F.col("id") % 20).cast("int"))).alias("date_start"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, str(200 * 1024))
    try:
        U.append_rows(registry.conform(rows), folder)
    finally:
        spark.conf.unset(key)
    stored = spark.read.parquet(folder)
    files = stored.select("date_start", F.col("_metadata.file_path").alias("f")).distinct()
    per_day = {str(r[0]): r[1] for r in files.groupBy("date_start").count().collect()}
    assert per_day["2024-01-01"] > 2 and max(v for d, v in per_day.items() if d != "2024-01-01") <= 2
    assert stored.count() == 30000
