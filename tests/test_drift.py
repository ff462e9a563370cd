import pytest
from conftest import plan_of
from pyspark.sql import types as T

from adledger import registry
from adledger.operators import drift as D, upsert as U

WANTED = registry.schema_for("insights")


def write(spark, path, sql, mode="append"):
    spark.sql(sql).write.mode(mode).partitionBy("date_start").parquet(path)


OLD = (
    "SELECT '1' AS account_id, '7' AS ad_id, 5 AS clicks, CAST(0.5 AS FLOAT) AS spend, 'x' AS note, DATE '2024-01-01' AS date_start, "
    "array(named_struct('value', 3, 'action_type', 'lead'), NULL) AS actions"
)
NEW = (
    "SELECT '1' AS account_id, '8' AS ad_id, 5000000000 AS clicks, 0.1D AS spend, 'n' AS ad_name, DATE '2024-01-02' AS date_start, "
    "array(named_struct('action_type', 'lead', 'value', 4L)) AS actions"
)


def test_changes_by_column(spark):
    found = T.StructType.fromDDL("a int, b bigint, c array<struct<v:int,k:string,more:int>>, e string, g struct<x:float>")
    wanted = T.StructType.fromDDL("a bigint, b double, c array<struct<k:string,v:bigint>>, d date, e string, g struct<x:double,y:int>")
    got = {c.column: c.action for c in D.compare(found, wanted)}
    assert got == {
        "a": "widen", "b": "refuse", "c.k": "same", "c.v": "widen", "c.more": "extra", "d": "add", "e": "same",
        "g.x": "widen", "g.y": "add",
    }
    assert D.compare(T.StructType.fromDDL("a array<struct<v:int>>"), T.StructType.fromDDL("a struct<v:int>"))[0].action == "refuse"


@pytest.fixture
def two_ages(spark, folder):
    for sql in (OLD, NEW, OLD.replace("'7'", "'9'").replace("2024-01-01", "2024-01-02")):
        write(spark, folder, sql)
    return folder


def test_ages_are_found_within_a_day_too(spark, two_ages):
    found = D.ages(spark, two_ages)
    assert sorted(len(a.files) for a in found) == [1, 2]
    rows = {(r.column, r.action, r.n_files) for r in D.drift(spark, two_ages).collect()}
    assert {("clicks", "widen", 2), ("spend", "widen", 2), ("note", "extra", 2), ("actions.value", "widen", 2)} <= rows
    assert ("ad_name", "add", 2) in rows and ("ad_name", "add", 1) not in rows
    assert not any(action == "refuse" for _, action, _ in rows)


def test_rows_of_both_ages(spark, two_ages):
    df = D.read_any_age(spark, two_ages)
    assert df.schema.simpleString() == WANTED.simpleString()
    rows = df.selectExpr("ad_id", "clicks", "spend", "ad_name", "to_json(actions)", "string(date_start)").collect()
    three = '[{"action_type":"lead","value":3},null]'
    assert sorted(map(tuple, rows)) == [
        ("7", 5, 0.5, None, three, "2024-01-01"),
        ("8", 5000000000, 0.1, "n", '[{"action_type":"lead","value":4}]', "2024-01-02"),
        ("9", 5, 0.5, None, three, "2024-01-02"),
    ]


def test_filters_and_columns_reach_every_scan(spark, two_ages):
    plan = plan_of(D.read_any_age(spark, two_ages).filter("date_start = '2024-01-02' AND ad_id = '9'").select("clicks"))
    assert plan.count("EqualTo(ad_id,9)") == 2 and "spend" not in plan.split("ReadSchema", 1)[1].split("\n")[0]
    assert "PartitionFilters: [isnotnull(date_start" in plan


def test_refusal_names_the_columns(spark, two_ages):
    write(spark, two_ages, "SELECT 'much' AS spend, 1.5D AS clicks, '1' AS ad_id, DATE '2024-01-03' AS date_start")
    with pytest.raises(D.Drifted, match=r"clicks \(double for bigint\), spend \(string for double\)"):
        D.read_any_age(spark, two_ages)
    assert {r.column for r in D.drift(spark, two_ages).filter("action = 'refuse'").collect()} == {"clicks", "spend"}


def test_table_without_files_and_without_drift(spark, folder):
    U.ensure_table(spark, folder)
    assert D.read_any_age(spark, folder).count() == 0
    U.append_rows(registry.conform(spark.sql(NEW)), folder)
    assert D.drift(spark, folder).count() == 0
    assert D.read_any_age(spark, folder).exceptAll(U.read_table(spark, folder)).count() == 0
