import os

import pytest
from pyspark.sql import functions as F

from adledger.functions.text import mask_columns
from adledger.operators.upsert import read_table
from adledger.operators.validate import check, until_first_error
from adledger.plans import sync as S
from adledger.session import size_for
from adledger.sources.landing import read_landing, scan_range, split_corrupt
from adledger.storage import run_folder, shared_root

from conftest import plan_of


def record(ad, day, **values):
    return {"account_id": "9", "ad_id": ad, "date_start": day, "date_stop": day, **values}


LEAD = {"user_friendly_name": "lead", "meta_action_type": "lead", "mapping_type": "pixel", "ad_account_id": "9"}
RECORDS = [
    record("1", "2024-01-05", clicks="1"),
    record("1", "2024-01-05", clicks="2"),
    record("2", "2024-01-06", clicks="bad"),
    record("3", "2024-01-07", actions=[{"action_type": "a", "value": "3"}]),
    record("4", "2024-02-01", clicks="4"),
    {**record("5", "2024-01-05"), "account_id": "8"},
]


def config(spark, **options):
    return S.SyncConfig(root=run_folder(spark, "sync"), accounts=["9"], **{"validate": True, **options})


def table(spark, cfg):
    return sorted((r.ad_id, r.clicks) for r in read_table(spark, cfg.path_of(cfg.table)).collect())


def test_full_sync(spark, rows_of):
    cfg = config(
        spark, quarantine_path=run_folder(spark, "q"), run_log_path=run_folder(spark, "log"), standard_mappings=[LEAD]
    )
    report = S.sync(spark, cfg, rows_of(RECORDS), as_of="2024-01-31")
    assert report["status"] == "completed"
    assert report["steps"] == {
        "kpi_mappings": {"status": "success", "mappings": {"standard": 1, "custom": 0, "total": 1}},
        "fetch_insights": {"status": "success", "total_records": 3},
        "validation": {"status": "success", "valid_records": 2, "invalid_records": 1},
        "upload": {"status": "success", "processed": 2, "rows_affected": 2},
    }
    assert table(spark, cfg) == [("1", 1), ("3", None)]
    bad = spark.read.json(cfg.quarantine_path).first()
    assert '"clicks":"bad"' in bad.record and bad.run_id == report["run_id"]
    assert bad.issues[0].code == "bad_value"
    runs = shared_root(spark) + "/adledger"
    assert not any(os.path.exists(f"{runs}/{f}/checked") for f in os.listdir(runs))
    log = spark.read.parquet(cfg.run_log_path).first()
    assert (log.status, log.total_records, log.processed) == ("completed", 3, 2)


def test_repeating_a_sync_changes_nothing(spark, rows_of):
    cfg = config(spark)
    for _ in range(2):
        S.date_range_sync(spark, cfg, rows_of(RECORDS), "2024-01-01", "2024-02-01")
        assert table(spark, cfg) == [("1", 1), ("3", None), ("4", 4)]


def test_incremental_takes_late_changes(spark, rows_of):
    cfg = config(spark, update_kpis=False)
    S.sync(spark, cfg, rows_of(RECORDS), as_of="2024-01-31")
    late = [record("1", "2024-01-05", clicks="7"), record("9", "2023-12-01")]
    report = S.incremental_sync(spark, cfg, rows_of(late), as_of="2024-01-10")
    assert report["steps"]["upload"]["processed"] == 1
    assert report["steps"]["kpi_mappings"] == {"status": "skipped"}
    assert table(spark, cfg) == [("1", 7), ("3", None)]


def test_no_data(spark, rows_of):
    cfg = config(spark)
    report = S.date_range_sync(spark, cfg, rows_of(RECORDS), "2020-01-01", "2020-01-02")
    assert report["status"] == "completed_no_data" and "upload" not in report["steps"]


def test_validate_only_writes_no_table(spark, rows_of):
    cfg = config(spark, validate=False)
    report = S.validate_only(spark, cfg, rows_of(RECORDS), as_of="2024-01-31")
    assert report["steps"]["validation"]["invalid_records"] == 1
    assert report["steps"]["upload"] == {"status": "skipped"} == report["steps"]["kpi_mappings"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, cfg.path_of(cfg.table)).count()


def test_without_validation_a_bad_row_fails_the_run(spark, rows_of):
    cfg = config(spark, validate=False, run_log_path=run_folder(spark, "log"))
    with pytest.raises(ValueError, match="1 rows do not fit"):
        S.sync(spark, cfg, rows_of(RECORDS), as_of="2024-01-31")
    assert spark.read.parquet(cfg.run_log_path).first().status == "failed"
    report = S.sync(spark, cfg, rows_of(RECORDS[:2]), as_of="2024-01-31")
    assert report["steps"]["validation"] == {"status": "skipped"} and table(spark, cfg) == [("1", 1)]


def test_range_needs_both_ends(spark, rows_of):
    cfg = config(spark, update_kpis=False)
    with pytest.raises(ValueError, match="both its ends"):
        S.date_range_sync(spark, cfg, rows_of(RECORDS), "2024-01-01", "")
    with pytest.raises(ValueError, match="both its ends"):
        S.sync(spark, cfg, rows_of(RECORDS), since="2024-01-01")


def test_tables_and_catalog(spark, rows_of):
    cfg = config(spark, dataset="sync_ads", kpi_table="sync_ref.kpi", register=True, standard_mappings=[LEAD]).for_test_table()
    assert cfg.path_of(cfg.table).endswith("/sync_ads/daily_test")
    for _ in range(2):
        S.sync(spark, cfg, rows_of(RECORDS), as_of="2024-01-31")
        assert spark.table("sync_ads.daily_test").count() == 2
        assert spark.table("sync_ref.kpi").count() == 1
    spark.sql("DROP DATABASE sync_ads CASCADE")
    spark.sql("DROP DATABASE sync_ref CASCADE")


def test_mask_columns(spark):
    df = spark.createDataFrame([("secret-1234", "k"), ("", None), (None, "")], "a string, b string")
    got = mask_columns(df, tail=("a",), full=("b",)).collect()
    assert [tuple(r) for r in got] == [("1234", "***"), (None, None), (None, None)]


def test_undated_rows_are_checked_and_foreign_ones_left_out(spark, rows_of):
    rows = rows_of([{"account_id": "9", "ad_id": "1"}, {"ad_id": "1", "date_start": "2024-01-05"}, record("2", "n/a")])
    cfg = config(spark)
    report = S.sync(spark, cfg, rows.withColumn("x", F.lit(1)), as_of="2024-01-31")
    assert report["steps"]["validation"] == {"status": "success", "valid_records": 1, "invalid_records": 1}
    assert table(spark, cfg) == [("1", None)]
    issue = spark.read.json(cfg.quarantine).first().issues[0]
    assert (issue.code, issue.field, issue.value) == ("bad_value", "date_start", "n/a")


def test_two_spellings_of_a_day_are_one_row(spark, rows_of):
    cfg = config(spark)
    rows = rows_of([record("1", "2024-01-05", clicks="1"), record("1", "2024-1-5", clicks="2")])
    for _ in range(2):
        S.sync(spark, cfg, rows, as_of="2024-01-31")
        assert len(table(spark, cfg)) == 1


def test_arguments_are_checked_before_anything_is_written(spark, rows_of):
    cfg = config(spark, standard_mappings=[LEAD])
    with pytest.raises(ValueError, match="both its ends"):
        S.sync(spark, cfg, rows_of(RECORDS), since="2024-01-01")
    assert not os.path.exists(cfg.root)


def test_landing_with_broken_lines(spark, folder):
    lines = [
        '{"account_id":"9","ad_id":"1","date_start":"2024-01-05","clicks":"1"}',
        '{"account_id":"9","ad_id":"2","date_st',
        '{"account_id":"9","ad_id":"3","date_start":"2024-01-05","clicks":"x"}',
    ]
    files = spark.createDataFrame([("9", x) for x in lines], "account_id string, value string")
    files.write.partitionBy("account_id").text(folder)
    flat = folder + "-flat"
    files.select("value").write.text(flat)
    for path in (folder, flat):
        cfg = config(spark)
        report = S.sync_landing(spark, cfg, path, as_of="2024-01-31")
        assert report["steps"]["fetch_insights"] == {"status": "success", "total_records": 3, "corrupt_lines": 1}
        assert report["steps"]["validation"]["invalid_records"] == 2
        assert table(spark, cfg) == [("1", 1)]
        kept = spark.read.json(cfg.quarantine).select("record", F.inline("issues")).collect()
        assert sorted(r.code for r in kept) == ["bad_value", "not_json"]
        assert lines[1] in [r.record for r in kept]
    frame = spark.createDataFrame([("9",), ("9",)], "account_id string")
    cfg = S.SyncConfig(root=run_folder(spark, "sync"), accounts=frame, validate=True)
    assert S.sync_landing(spark, cfg, flat, as_of="2024-01-31")["steps"]["fetch_insights"]["total_records"] == 3


def test_one_scan_serves_rows_and_broken_lines(spark, folder):
    """Folders are pruned by account and day, and no second scan looks for broken lines."""
    line = '{"ad_id":"1","clicks":"1"}'
    files = spark.createDataFrame([("9", "2024-01-05", line), ("8", "2024-01-05", line)], "account_id string, date_start string, value string")
    files.write.partitionBy("account_id", "date_start").text(folder)
    rows = read_landing(spark, folder, accounts=["9"], since="2024-01-01", until="2024-01-31")
    plan = plan_of(S.prepared(scan_range(rows, ["9"], "2024-01-01", "2024-01-31", keep_unknown=True)))
    assert plan.count("Scan json") == 2  # in the tree, and in its details
    pruned = plan.split("PartitionFilters: ")[1].split("\n")[0]
    assert "account_id" in pruned and "date_start" in pruned


def test_first_error_cut_by_place(spark, folder):
    """The ingest order of a file scan is a struct; the cut compares it as one value."""
    lines = [f'{{"ad_id":"{i}","clicks":"{"x" if i == 3 else i}"}}' for i in range(6)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)
    rows, _ = split_corrupt(read_landing(spark, folder))
    kept = until_first_error(check(rows)).collect()
    assert sorted(r.ad_id for r in kept) == ["0", "1", "2", "3"]


def test_size_for(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    size_for(spark, 100 * 1024**4)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "102400"
    spark.conf.set("spark.sql.shuffle.partitions", before)
    for key in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
        spark.conf.unset(key)


def test_run_by_mode(spark, rows_of):
    cfg, rows = config(spark), rows_of(RECORDS)
    request = S.Request("daterange", start="2024-01-01", end="2024-01-31", use_test_table=True)
    report = S.run(spark, cfg, rows, request)
    assert report["table"] == "daily_test"
    assert (report["request"]["start"], report["request"]["end"]) == ("2024-01-01", "2024-01-31")
    assert table(spark, cfg.for_test_table()) == [("1", 1), ("3", None)]
    request = S.Request(as_of="2024-01-07", days_back=1, dry_run=True, skip_kpi_update=True)
    report = S.run(spark, cfg, rows, request)
    assert report["steps"]["fetch_insights"]["total_records"] == 2
    assert report["steps"]["upload"] == {"status": "skipped"} == report["steps"]["kpi_mappings"]
    assert S.run(spark, cfg, rows, S.Request("full", as_of="2024-01-31", dry_run=True))["status"] == "completed"
    with pytest.raises(ValueError, match="unknown mode"):
        S.run(spark, cfg, rows, S.Request("hourly"))
    with pytest.raises(ValueError, match="both its ends"):
        S.run(spark, cfg, rows, S.Request("daterange", start="2024-01-01"))
