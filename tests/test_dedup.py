from conftest import tree_of
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from adledger.operators.dedup import dedup_stats, distinct_keys, keep_latest

SCHEMA = "_seq long, ad_id string, date_start string, account_id string, date_stop string"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


def kept(df):
    return sorted(r["_seq"] for r in keep_latest(df).select("_seq").collect())


def test_first_of_the_greatest_wins(spark):
    key = ("1", "2024-01-01", "9")
    assert kept(frame(spark, [(*key, "01"), (*key, "02"), (*key, "02")])) == [1]


def test_missing_keys_are_one_group(spark):
    assert kept(frame(spark, [(None, None, None, None), (None, None, None, None)])) == [0]


def test_missing_version_is_lowest_and_equals_empty(spark):
    key = ("1", "2024-01-01", "9")
    assert kept(frame(spark, [(*key, None), (*key, "2024"), (*key, "")])) == [1]
    assert kept(frame(spark, [(*key, ""), (*key, None)])) == [0]
    assert kept(frame(spark, [(*key, None), (*key, "")])) == [0]


VALUE = st.one_of(st.none(), st.sampled_from(["", "a", "b", "é"]))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(VALUE, VALUE, VALUE, VALUE), max_size=40), st.integers(1, 6))
def test_agrees_with_brute_force_in_any_partitioning(spark, rows, parts):
    best = {}
    for i, (*key, stop) in enumerate(rows):
        key = tuple(key)
        if key not in best or (stop or "") > (rows[best[key]][3] or ""):
            best[key] = i
    df = frame(spark, rows).repartition(parts, F.rand(1))
    assert kept(df) == sorted(best.values())
    stats = dedup_stats(df).first()
    assert tuple(stats) == (len(rows), len(best), len(rows) - len(best))
    assert distinct_keys(df).count() == len(best)


def test_columns_the_rows_do_not_have(spark):
    df = frame(spark, [("1", "d", "9", "a"), ("1", "d", "8", "b"), ("2", "d", "9", "c")])
    assert kept(df.drop("account_id", "date_stop")) == [0, 2]


def test_typed_version(spark):
    df = frame(spark, [("1", "d", "9", None), ("1", "d", "9", "2024-01-02"), ("1", "d", "9", "2024-01-01")])
    typed = df.withColumn("date_stop", F.to_date("date_stop"))
    assert kept(typed) == [1]


def test_a_task_sends_one_row_per_key(spark):
    """The group limit runs before the shuffle, so one huge key is no problem."""
    hot = spark.range(0, 20000, 1, 8).select(
        F.col("id").alias("_seq"),
        (F.col("id") % 1).cast("string").alias("ad_id"),
        F.lit("d").alias("date_start"),
        F.lit("9").alias("account_id"),
        F.lit("s").alias("date_stop"),
    )
    out = keep_latest(hot)
    tree = tree_of(out)
    assert tree.count("WindowGroupLimit") == 2 and tree.count("Exchange") == 1
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange")
    assert [r["_seq"] for r in out.collect()] == [0]


def test_the_day_is_read_once_per_row(rows_of):
    """Not again in every exchange, comparison and window."""
    from conftest import plan_of

    plan = plan_of(keep_latest(rows_of([{"ad_id": "1", "date_start": "2024-01-01", "account_id": "9"}])))
    details = [part for part in plan.split("\n\n") if part.startswith("(") and "RLIKE" in part.upper()]
    assert len(details) == 1, details
