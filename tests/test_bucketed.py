import pytest
from conftest import tree_of

from adledger import registry
from adledger.operators import bucketed as B, upsert as U


def table_rows(spark, records):
    """Typed rows of the table from (account, ad, day, clicks)."""
    df = spark.createDataFrame(records, "account_id string, ad_id string, date_start string, clicks long")
    return registry.conform(df)


def content(df):
    rows = df.select("account_id", "ad_id", df.date_start.cast("string"), "clicks").collect()
    return sorted(map(tuple, rows), key=str)


OLD = [("1", str(ad), f"2024-01-0{day}", ad * day) for ad in range(30) for day in (1, 2, 3)]
NEW = [("1", str(ad), "2024-01-02", -ad) for ad in range(20, 40)] + [("2", "3", "2024-01-05", 7)]
MISSING = [(None, "1", "2024-01-02", 1), (None, "1", "2024-01-02", 1), ("1", None, "2024-01-02", 2), ("1", "1", None, 3)]


@pytest.fixture
def tables(spark, folder):
    """The same two merges in buckets and without them."""
    for rows in (OLD + MISSING, NEW + MISSING):
        src = table_rows(spark, rows)
        assert B.upsert(src, f"{folder}/b", 4) == U.upsert(src, f"{folder}/p")
    return f"{folder}/b", f"{folder}/p"


def test_same_rows_as_without_buckets(spark, tables):
    bucketed, plain = tables
    assert content(B.read(spark, bucketed)) == content(U.read_table(spark, plain))


def test_other_days_and_other_sessions(spark, tables):
    bucketed, plain = tables
    spark.sql(f"DROP TABLE {B.ensure(spark, bucketed)}")  # as in a new session: the folder is all there is
    again = table_rows(spark, [("1", "5", "2024-01-03", 99)])
    assert B.upsert(again, bucketed) == U.upsert(again, plain)
    assert content(B.read(spark, bucketed)) == content(U.read_table(spark, plain))


def test_old_rows_are_not_shuffled(spark, tables):
    old = spark.table(B.ensure(spark, tables[0])).filter("date_start = '2024-01-02'")
    src = table_rows(spark, NEW)
    def above_old():
        tree = tree_of(B.merged(old, src, 4))
        return tree[: tree.index("Scan parquet")]

    with B.co_partitioned(spark):
        assert "SortMergeJoin" in above_old() and "Exchange" not in above_old()
    assert "Exchange" in above_old()  # without the setting


def test_few_files_per_bucket(spark, tables):
    files = spark.table(B.ensure(spark, tables[0])).filter("date_start = '2024-01-02'").inputFiles()
    assert len(files) <= 2 * 4


def test_loose_rows_lie_apart(spark, tables):
    rows = spark.table(B.ensure(spark, tables[0]))
    assert rows.filter("account_id IS NULL OR ad_id IS NULL OR date_start IS NULL").count() == 0


def test_refusals(spark, tables, folder):
    src = table_rows(spark, NEW)
    with pytest.raises(ValueError, match="has 4 buckets, not 8"):
        B.upsert(src, tables[0], 8)
    with pytest.raises(ValueError, match="how many buckets"):
        B.upsert(src, f"{folder}/absent")
    with pytest.raises(ValueError, match="the key must hold"):
        B.upsert(src, tables[0], keys=("ad_id", "date_start"))
    with pytest.raises(ValueError, match="several rows"):
        B.upsert(src.unionByName(src), tables[0])


def test_empty_source(spark, tables):
    before = content(B.read(spark, tables[0]))
    assert B.upsert(table_rows(spark, []), tables[0])["status"] == "no_records"
    assert content(B.read(spark, tables[0])) == before


def test_number_of_buckets():
    assert B.buckets_for(0, 0) == 1
    assert B.buckets_for(100 * 1024**4, 1000) == 410
