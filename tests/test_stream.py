"""The file stream against one sync per load, and restarts."""

import json

import pytest

from adledger.operators import upsert, versions
from adledger.plans import fixtures as fx, stream, sync
from adledger.storage import run_folder

SF_DIR = "/root/testdata/sf0.001"


def table(spark, config):
    rows = versions.read(spark, config.path_of(config.table)).drop("actions")
    return sorted(map(str, rows.collect()))


@pytest.fixture
def config(spark):
    return sync.SyncConfig(root=run_folder(spark, "stream"), accounts=fx.ACCOUNTS, validate=True, update_kpis=False)


def run(spark, config, path, **options):
    return stream.stream_sync(spark, config, path, f"{config.root}/checkpoint", schema=fx.landing_schema(), **options)


def test_loads_equal_syncs_and_files_are_read_once(spark, config):
    path = run_folder(spark, "landing")
    plain = sync.SyncConfig(root=run_folder(spark, "plain"), accounts=fx.ACCOUNTS, validate=True, update_kpis=False)
    rows = fx.ads_raw(spark, SF_DIR)
    for load in (1, 2):
        fx.write_landing(spark, SF_DIR, path, load=load)
        reports = run(spark, config, path)
        one = rows.where(f"load_no = {load}").select("_seq", *fx.RAW_FIELDS, "actions")
        report = sync.sync(spark, plain, one, "2023-01-01", "9999-12-31")
        assert len(reports) == 1
        for step, count in (("fetch_insights", "total_records"), ("validation", "valid_records"), ("validation", "invalid_records")):
            assert reports[0][count] == report["steps"][step][count]
    assert run(spark, config, path) == []
    expected = upsert.read_table(spark, plain.path_of(plain.table)).drop("actions")
    assert table(spark, config) == sorted(map(str, expected.collect()))
    rejected = spark.read.json(config.quarantine)
    assert rejected.select("run_id").distinct().count() == 2


def write(spark, path, *records):
    lines = [json.dumps(r) if isinstance(r, dict) else r for r in records]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def record(n, clicks, day="2024-01-05", account="900"):
    return {"_seq": n, "account_id": account, "ad_id": str(n % 10), "date_start": day, "date_stop": day, "clicks": clicks}


@pytest.mark.parametrize("when", ["before", "after"])
def test_restart_in_the_middle(spark, config, monkeypatch, when):
    """A batch that failed before or after its commit is repeated and counts once."""
    path = run_folder(spark, "landing")
    write(spark, path, record(1, "1"), record(2, "1"), {**record(3, "1"), "ad_id": None}, "not json", "neither is this")
    assert [r["invalid_records"] for r in run(spark, config, path)] == [2]
    write(spark, path, record(11, "5"), {**record(4, "x")}, {**record(5, "2"), "ad_id": None}, record(6, "1", account="1"))
    real = versions.upsert

    def failing(*args, **options):
        if when == "after":
            real(*args, **options)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(versions, "upsert", failing)
    with pytest.raises(Exception, match="lost driver"):
        run(spark, config, path)
    monkeypatch.setattr(versions, "upsert", real)
    reports = run(spark, config, path)
    assert [(r["total_records"], r["invalid_records"]) for r in reports] == [(3, 1)]
    assert reports[0]["status"] == ("replayed" if when == "after" else "success")
    rows = versions.read(spark, config.path_of(config.table)).select("ad_id", "clicks").collect()
    assert sorted((r.ad_id or "", r.clicks) for r in rows) == [("", 1), ("", 2), ("1", 5), ("2", 1)]
    assert spark.read.json(config.quarantine).count() == 3
