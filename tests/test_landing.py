import pytest
import json
import os

from conftest import plan_of
from pyspark.sql import functions as F

from adledger.operators.dedup import keep_latest
from adledger.sources import landing


def write(folder, files):
    path = folder.removeprefix("file:")
    for name, lines in files.items():
        os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
        with open(f"{path}/{name}", "w") as out:
            out.write("\n".join(lines))
    return path


def line(**values):
    return json.dumps(values)


def test_shapes_survive_and_numbers_stay_text(spark, folder):
    path = write(folder, {"account_id=9/a.json": [line(ad_id=1, impressions=7.0, actions={"a": 1}, other="x")]})
    row = landing.read_landing(spark, path).select("*", F.to_json("actions").alias("j")).first()
    assert (row.account_id, row.ad_id, row.impressions, row.j) == ("9", "1", "7.0", '{"a":1}')


def test_place_order_is_ingest_order(spark, folder):
    day = {"ad_id": "1", "date_start": "2024-01-01", "date_stop": "2024-01-02"}
    files = {
        "account_id=9/b.json": [line(ad_name=f"b{i}", **day) for i in range(5)],
        "account_id=9/a.json": [line(ad_name=f"a{i}", **day) for i in range(500)],
    }
    path = write(folder, files)
    rows, _ = landing.split_corrupt(landing.read_landing(spark, path))
    assert keep_latest(rows.repartition(7)).first().ad_name == "a0"
    by_place = [r.ad_name for r in rows.repartition(5).orderBy("_seq").collect()]
    assert by_place == [f"a{i}" for i in range(500)] + [f"b{i}" for i in range(5)]


def test_bad_lines_and_missing_accounts_do_not_stop_the_others(spark, folder):
    path = write(
        folder,
        {
            "account_id=1/a.json": [line(ad_id="1"), line(ad_name="no ad")],
            "account_id=2/a.json": [line(ad_id="1"), '{"ad_id": "2", "spe'],
        },
    )
    rows = landing.read_landing(spark, path)
    good, bad = landing.split_corrupt(rows)
    assert (good.count(), bad.count()) == (3, 1)
    assert {tuple(r) for r in landing.account_status(rows, ["1", "2", "3"]).collect()} == {
        ("1", 2, 1, 0, "ok"),
        ("2", 1, 0, 1, "corrupt"),
        ("3", 0, 0, 0, "missing"),
    }


def test_range_takes_all_spellings_of_a_day(spark):
    texts = ["2024-01-05", "2024-1-5", "2024-01- 5", "2024-01-20", "2024-01-21", "2023-12-31", "2024-10-05", "x", None]
    rows = spark.createDataFrame([("a", t) for t in texts], "account_id string, date_start string")
    got = landing.scan_range(rows, ["a"], "2024-01-01", "2024-01-20")
    assert sorted(r.date_start for r in got.collect()) == sorted(texts[:4])
    long = landing.scan_range(rows, ["a"], "2022-01-01", "2024-10-04")
    assert long.count() == 6
    across = landing.scan_range(rows, ["a"], "2023-12-31", "2024-01-05")
    assert across.count() == 4


def test_filters_reach_partitions_and_files(spark, folder):
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd")
    rows = spark.range(60).select(
        (F.col("id") % 3).cast("string").alias("account_id"), day.alias("date_start"), F.lit("1").alias("ad_id")
    )
    rows.write.partitionBy("account_id", "date_start").json(folder)
    scan = landing.read_landing(spark, folder, accounts=["1"], since="2024-01-01", until="2024-01-10")
    assert scan.count() == 3
    plan = plan_of(scan)
    pruned = plan.split("PartitionFilters: ")[1].split("\n")[0]
    assert "account_id" in pruned and "date_start" in pruned

    flat = folder + "-flat"
    rows.write.parquet(flat)
    plan = plan_of(landing.scan_range(spark.read.parquet(flat), ["1"], "2024-01-01", "2024-01-10"))
    assert "GreaterThanOrEqual(date_start,2024-)" in plan and "EqualTo(account_id,1)" in plan


@pytest.mark.parametrize("until", ["2024-12-31", "2025-01-31", "9998-12-31", "9999-12-31"])
def test_open_ranges(spark, until):
    texts = ["2024-01-05", "2024-6-5", "2024-12-31", None, "n/a"]
    rows = spark.createDataFrame([("a", t) for t in texts], "account_id string, date_start string")
    assert landing.scan_range(rows, ["a"], "2024-01-01", until).count() == 3
    assert landing.scan_range(rows, ["a"], "2024-01-06", until, keep_unknown=True).count() == 4


def test_parquet_landing(spark, folder):
    rows = spark.sql("SELECT '9' AS account_id, '1' AS ad_id, '2024-01-01' AS date_start, parse_json('[]') AS actions")
    rows.write.parquet(folder)
    got = landing.read_landing(spark, folder, fmt="parquet", accounts=["9"], since="2024-01-01", until="2024-01-01")
    assert got.count() == 1 and "_seq" in got.columns


def test_accounts_as_a_frame(spark):
    rows = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "1")], "account_id string, id string")
    wanted = spark.createDataFrame([("a",)], "account_id string")
    assert [r.ad_id for r in landing.list_ads(rows, wanted).collect()] == ["1", "1"]


def test_preset_and_look_back(spark):
    texts = ["2023-12-31", "2024-01-01", "2024-01-30", "2024-01-31"]
    rows = spark.createDataFrame([("a", t) for t in texts], "account_id string, date_start string")
    got = landing.scan_preset(rows, ["a"], "2024-01-31").collect()
    assert sorted(r.date_start for r in got) == ["2024-01-01", "2024-01-30"]
    since, until = landing.look_back("2024-01-31")
    assert (str(since), str(until)) == ("2024-01-24", "2024-01-31")


def test_project_fields(spark):
    rows = spark.sql("SELECT 1 AS _seq, 'a' AS ad_id, 'x' AS unknown, parse_json('1') AS purchase_roas")
    assert landing.project_fields(rows).columns == ["_seq", "ad_id", "purchase_roas"]
    assert landing.project_fields(rows, ["unknown"]).columns == ["_seq", "unknown"]


def test_unreadable_files_are_left_out_named_and_counted(spark, folder, tmp_path):
    """A cut gzip and a broken Parquet file among good ones; a second run reads no file again."""
    import gzip
    import json
    import os

    from adledger.plans.sync import SyncConfig, sync_landing, update_ledger

    def lines(account, n):
        return "\n".join(
            json.dumps({"account_id": account, "ad_id": str(i), "date_start": "2024-01-05", "date_stop": "2024-01-05"}) for i in range(n)
        ).encode()

    os.makedirs(tmp_path / "json")
    (tmp_path / "json" / "a.json.gz").write_bytes(gzip.compress(lines("900", 50)) + gzip.compress(b"\n" + lines("901", 7)))
    (tmp_path / "json" / "b.json.gz").write_bytes(gzip.compress(lines("902", 5000))[:-40])
    (tmp_path / "json" / "c.json").write_bytes(lines("903", 3))
    config = SyncConfig(root=folder, accounts=["900", "901", "902", "903"], validate=True, update_kpis=False, run_log_path=f"{folder}/runs")
    ledger = f"{folder}/ledger"
    for total in (60, 65):
        report = sync_landing(spark, config, str(tmp_path / "json"), "2024-01-01", "2024-01-31", ledger_path=ledger)
        step = report["steps"]["fetch_insights"]
        assert (step["total_records"], step["files_listed"]) == (total, 3 if total == 60 else 4)
        assert [os.path.basename(f) for f in step["files_skipped"]] == ["b.json.gz"]
        (tmp_path / "json" / "d.json.gz").write_bytes(gzip.compress(lines("903", 8)))
    logged = spark.read.parquet(f"{folder}/runs").where("size(files_skipped) = 1")
    assert logged.count() == 2

    good = f"{tmp_path}/parquet"
    spark.range(100).selectExpr("'900' AS account_id", "string(id) AS ad_id", "'2024-01-05' AS date_start").repartition(2).write.parquet(good)
    names = sorted(n for n in os.listdir(good) if n.endswith(".parquet"))
    whole = (tmp_path / "parquet" / names[0]).read_bytes()
    (tmp_path / "parquet" / "broken-1.parquet").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "parquet" / "broken-2.parquet").write_bytes(whole[:10] + bytes(40) + whole[50:])
    found = update_ledger(spark, good, f"{folder}/ledger-parquet")
    bad = landing.unreadable(found)
    assert [os.path.basename(f) for f in bad] == ["broken-1.parquet", "broken-2.parquet"]
    schema = "account_id string, ad_id string, date_start string"
    schema = spark.createDataFrame([], schema).schema
    rows = landing.read_landing(spark, good, "parquet", schema=schema, skip_files=bad)
    assert rows.count() == 100
