from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from adledger.operators import kpi
from adledger.sources import conversions

TS = datetime(2024, 2, 1, tzinfo=timezone.utc)


def mapping(spark, rows):
    return spark.createDataFrame(
        rows, "ad_account_id string, user_friendly_name string, meta_action_type string"
    )


def documents(spark, folder, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(folder)
    return conversions.read_documents(spark, folder)


LINES = [
    '{"account":"act_1","data":[{"id":"10","name":"A","custom_event_type":"X"},{"id":11,"name":"B"}]}',
    '{"account":"2","data":[]}',
    '{"account":"3"}',
    '{"account":"4","data":[{"id":"12","name":"C"},{"id":"13"}]}',
    '{"account":"5","data":{"id":"14","name":"D"}}',
    '{"account":"6","data":[{"id":"15","na',
    '{"account":"act_act_7","data":[{"id":"16","name":null}]}',
]


LEAD = {"user_friendly_name": "lead", "meta_action_type": "lead", "mapping_type": "pixel", "ad_account_id": "7"}


def test_custom_mappings(spark, folder):
    docs = documents(spark, folder, LINES)
    got = sorted(tuple(r) for r in conversions.custom_mappings(docs).collect() if r[0])
    assert got == [
        ("A", "offsite_conversion.custom.10", "custom", "1", "10"),
        ("B", "offsite_conversion.custom.11", "custom", "1", "11"),
    ]
    unnamed = conversions.custom_mappings(docs).filter("user_friendly_name IS NULL").collect()
    assert [r.ad_account_id for r in unnamed] == ["7"]
    assert sorted(str(r.account) for r in conversions.failed_documents(docs).collect()) == ["4", "5", "None"]


def test_refresh_replaces_and_counts(spark, folder):
    standard = kpi.standard_mappings(spark, [LEAD])
    custom = conversions.custom_mappings(documents(spark, folder + "-docs", LINES))
    assert kpi.refresh(standard, custom, folder, TS) == {"standard": 1, "custom": 3, "total": 4}
    assert kpi.refresh(standard, None, folder, TS) == {"standard": 1, "custom": 0, "total": 1}
    row = kpi.read_mappings(spark, folder).first()
    assert (row.mapping_type, row.facebook_conversion_id) == ("pixel", None)
    assert row.last_updated == TS.replace(tzinfo=None)
    later = [TS + timedelta(days=d) for d in (1, 2, 3)]
    for ts in later:
        kpi.refresh(standard, None, folder, ts)
    assert kpi.read_mappings(spark, folder).count() == 1
    assert kpi.versions(spark, folder) == [f"{ts:%Y%m%d%H%M%S%f}" for ts in later[1:]]


def test_a_failed_refresh_leaves_the_table(spark, folder):
    standard = kpi.standard_mappings(spark, [LEAD])
    kpi.refresh(standard, None, folder, TS)
    broken = standard.withColumn("user_friendly_name", F.raise_error(F.lit("unreadable")).cast("string"))
    with pytest.raises(Exception, match="unreadable"):
        kpi.refresh(standard, broken, folder, TS + timedelta(days=1))
    assert [r.meta_action_type for r in kpi.read_mappings(spark, folder).collect()] == ["lead"]


def test_nothing_to_write(spark, folder):
    none = kpi.standard_mappings(spark)
    assert kpi.refresh(none, None, folder, TS) == {"standard": 0, "custom": 0, "total": 0}
    assert kpi.lookup_columns(spark, folder).count() == 0


REQUESTS = [("900", "click"), ("901", "click"), ("900", "view"), ("900", "none"), ("900", "nulled"), (None, "click")]


def test_resolve(spark):
    table = mapping(
        spark,
        [("all", "click", "any"), ("900", "click", "own"), ("all", "view", "any.view"),
         ("900", "nulled", None), ("all", "nulled", "any.nulled")],
    )
    requests = spark.createDataFrame(REQUESTS, "ad_account_id string, kpi_name string")
    got = kpi.resolve(requests, table)
    assert {(r[0], r[1]): r[2] for r in got.collect()} == dict(
        zip(REQUESTS, ["own", "any", "any.view", None, None, "any"])
    )


def test_latest_takes_the_last_written(spark):
    old = mapping(spark, [("all", "click", "zzz"), ("1", "a", "x")]).withColumn("last_updated", F.lit(1))
    new = mapping(spark, [("all", "click", "b"), ("all", "click", "a")]).withColumn("last_updated", F.lit(2))
    got = {r.mapping_key: r.meta_action_type for r in kpi.latest(old.unionByName(new)).collect()}
    assert got == {"all:click": "b", "1:a": "x"}


def test_summary_leaves_out_missing_keys(spark):
    rows = spark.createDataFrame(
        [("1", "custom"), ("1", "custom"), (None, "custom"), ("1", None)], "ad_account_id string, mapping_type string"
    )
    assert [tuple(r) for r in kpi.summary(rows).collect()] == [("1", "custom", 2)]

