"""Registered queries: one per operator, each over the whole of its input tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from adledger import registry
from adledger.functions import text
from adledger.functions.text import day_text, with_account_prefix, without_account_prefix
from adledger.operators import bucketed, dedup, drift, kpi, profile, upsert, validate, versions
from adledger.plans import fixtures as fx, stream
from adledger.plans import sync as jobs
from adledger.sources import conversions, landing, windows
from adledger.storage import run_folder, stage, staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RUN_TS = datetime(2024, 2, 1, 12, 0, 0, tzinfo=timezone.utc)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _flat(df: DataFrame) -> DataFrame:
    """Typed rows with days as text and the actions summed up."""
    total = F.aggregate(
        "actions", F.lit(0).cast("bigint"), lambda s, a: s + F.coalesce(a["value"], F.lit(0))
    )
    return df.select(
        "account_id",
        "ad_id",
        day_text(F.col("date_start")).alias("date_start"),
        day_text(F.col("date_stop")).alias("date_stop"),
        "impressions",
        "clicks",
        "spend",
        F.coalesce(F.size("actions"), F.lit(0)).cast("bigint").alias("n_actions"),
        F.coalesce(total, F.lit(0)).alias("action_sum"),
    )


def _raw(df: DataFrame) -> DataFrame:
    return df.select(F.col("_seq").alias("seq"), *fx.RAW_FIELDS)


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.check(fx.landing_rows(spark, sf_dir))


def _loaded(spark: SparkSession, sf_dir: str, label: str) -> str:
    """A table that holds the valid rows of the first load."""
    path = run_folder(spark, label)
    upsert.append_rows(fx.valid_load(spark, sf_dir, 1), path)
    return path


# -- scans -------------------------------------------------------------------------


@query
def scan_date_range(spark, sf_dir):
    path = run_folder(spark, "landing")
    fx.write_landing(spark, sf_dir, path)
    rows = landing.read_landing(
        spark, path, schema=fx.landing_schema(), accounts=fx.ACCOUNTS, since=fx.SINCE, until=fx.UNTIL
    )
    good, _ = landing.split_corrupt(rows)
    return _raw(dedup.keep_latest(landing.project_fields(good)))


@query
def open_range(spark, sf_dir):
    rows = landing.scan_range(fx.landing_rows(spark, sf_dir), fx.ACCOUNTS, "2024-01-10", "9999-12-31")
    return _raw(dedup.keep_latest(rows))


@query
def scan_last_30d(spark, sf_dir):
    rows = landing.scan_preset(fx.landing_rows(spark, sf_dir), fx.ACCOUNTS, fx.AS_OF)
    return _raw(dedup.keep_latest(rows))


@query
def chunk_plan(spark, sf_dir):
    days = fx.ads_raw(spark, sf_dir).agg(
        F.lit("all").alias("account_id"),
        F.to_date(F.min("date_start")).alias("first"),
        F.to_date(F.max("date_start")).alias("last"),
    )
    plan = windows.account_plan(days, F.col("first"), F.col("last"))
    return plan.select(*(day_text(F.col(c)).alias(c) for c in ("since", "until")))


@query
def chunk_account_plan(spark, sf_dir):
    days = (
        fx.ads_raw(spark, sf_dir)
        .groupBy("account_id")
        .agg(
            F.to_date(F.min("date_start")).alias("first"),
            F.to_date(F.max("date_start")).alias("last"),
        )
    )
    plan = windows.account_plan(days, F.col("first"), F.col("last"), 5)
    return plan.select("account_id", *(day_text(F.col(c)).alias(c) for c in ("since", "until")))


@query
def chunk_scan(spark, sf_dir):
    rows = landing.scan_windows(
        fx.landing_rows(spark, sf_dir), fx.ACCOUNTS, fx.SINCE, fx.UNTIL
    )
    return rows.select(
        F.col("_seq").alias("seq"),
        "account_id",
        "date_start",
        *(day_text(F.col(c)).alias(c) for c in ("since", "until")),
    )


@query
def plan_scan(spark, sf_dir):
    """Windows of 3 to 7 days, another length for every account, each from its own first day."""
    rows = fx.landing_rows(spark, sf_dir)
    days = rows.groupBy("account_id").agg(
        F.to_date(F.min("date_start")).alias("first"), F.to_date(F.max("date_start")).alias("last")
    )
    plans = [
        windows.account_plan(days.where(F.col("account_id") == a), F.col("first"), F.col("last"), 3 + i)
        for i, a in enumerate(fx.ACCOUNTS)
    ]
    plan = stage(reduce(DataFrame.unionByName, plans), "plan")
    return landing.scan_plan(rows, plan).select(
        F.col("_seq").alias("seq"),
        "account_id",
        "date_start",
        *(day_text(F.col(c)).alias(c) for c in ("since", "until")),
    )


@query
def scan_counts(spark, sf_dir):
    rows = fx.landing_rows(spark, sf_dir)
    return landing.scan_counts(
        landing.scan_windows(rows, fx.ACCOUNTS, fx.SINCE, fx.UNTIL)
    )


@query
def scan_skips_bad_account(spark, sf_dir):
    path = run_folder(spark, "landing")
    fx.write_landing(spark, sf_dir, path, faults=True)
    rows = landing.read_landing(spark, path, schema=fx.landing_schema())
    return landing.account_status(rows, [*fx.ACCOUNTS, "999"])


@query
def scan_skips_bad_file(spark, sf_dir):
    """A file of account 904 ends too early; it is left out and counted, the others are read."""
    path = run_folder(spark, "landing")
    fx.write_landing(spark, sf_dir, path, packed=True)
    lines = fx.landing_rows(spark, sf_dir).where("account_id = '904'").orderBy("_seq").limit(100)
    fx.write_cut_file(spark, path, "904", [r[0] for r in lines.select(F.to_json(F.struct("_seq", "ad_id", "date_start"))).collect()])
    ledger = stage(landing.file_ledger(spark, path), "ledger")
    rows = landing.read_landing(spark, path, schema=fx.landing_schema(), skip_files=landing.unreadable(ledger))
    account = F.regexp_extract("path", "account_id=([^/]+)/", 1).alias("account_id")
    skipped = ledger.groupBy(account).agg(F.count_if(~F.col("readable")).alias("files_skipped"))
    counts = rows.groupBy("account_id").agg(F.count("ad_id").alias("n_rows"))
    return counts.join(skipped, "account_id")


@query
def incremental_window(spark, sf_dir):
    since, until = landing.look_back("2024-01-30", 7)
    rows = landing.scan_range(fx.landing_rows(spark, sf_dir), fx.ACCOUNTS, since, until)
    return _raw(rows)


@query
def ad_listing(spark, sf_dir):
    ads = (
        fx.ads_raw(spark, sf_dir)
        .select("account_id", F.col("ad_id").alias("id"), F.concat(F.lit("ad "), "ad_id").alias("name"))
        .distinct()
    )
    return landing.list_ads(ads, fx.ACCOUNTS)


@query
def project_fields(spark, sf_dir):
    return _raw(landing.project_fields(fx.ads_raw(spark, sf_dir)))


@query
def run_sql(spark, sf_dir):
    return upsert.run_sql(
        spark,
        "SELECT account_id, event_type, count(*) AS n FROM {rows} "
        "WHERE array_contains(:kinds, event_type) AND date_start BETWEEN :a AND :b "
        "GROUP BY account_id, event_type",
        {"kinds": ["click", "view", "purchase"], "a": fx.SINCE, "b": fx.UNTIL},
        rows=fx.ads_raw(spark, sf_dir),
    )


# -- deduplication -----------------------------------------------------------------


@query
def dedup_latest(spark, sf_dir):
    return _raw(dedup.keep_latest(fx.landing_rows(spark, sf_dir)))


@query
def dedup_stats(spark, sf_dir):
    return dedup.dedup_stats(fx.landing_rows(spark, sf_dir))


@query
def existing_keys(spark, sf_dir):
    return dedup.distinct_keys(fx.ads_raw(spark, sf_dir), registry.LEGACY_KEYS)


# -- checks and casts --------------------------------------------------------------


@query
def validate_issues(spark, sf_dir):
    issues = validate.issue_rows(_checked(spark, sf_dir))
    return issues.withColumnRenamed("_seq", "seq")


@query
def cast_typed(spark, sf_dir):
    rows = validate.valid_rows(_checked(spark, sf_dir))
    return _flat(rows).drop("n_actions", "action_sum")


@query
def cast_nested(spark, sf_dir):
    rows = validate.valid_rows(_checked(spark, sf_dir))
    return rows.select(F.col("_seq").alias("seq"), F.inline("actions"))


@query
def split_valid(spark, sf_dir):
    return _flat(validate.valid_rows(validate.check(dedup.keep_latest(fx.landing_rows(spark, sf_dir)))))


@query
def split_invalid(spark, sf_dir):
    rows = validate.invalid_rows(validate.check(dedup.keep_latest(fx.landing_rows(spark, sf_dir))))
    return rows.select(
        F.col("_seq").alias("seq"),
        F.get_json_object("record", "$.ad_id").alias("ad_id"),
        F.array_join("issues.code", ",").alias("codes"),
    )


@query
def stop_first_error(spark, sf_dir):
    # Rows that fail a check are only left in from the middle on; failed casts come before that.
    middle = fx.table(spark, sf_dir, "events").agg(F.max("event_id") / 2).scalar()
    checked = _checked(spark, sf_dir).filter((F.col("_seq") > middle) | ~F.col("_bad"))
    rows = validate.until_first_error(checked)
    return rows.select(F.col("_seq").alias("seq"), F.col("_ok").alias("ok"))


@query
def validation_counts(spark, sf_dir):
    return validate.verdict_counts(_checked(spark, sf_dir))


@query
def field_conforms(spark, sf_dir):
    by_name = {f.name: f for f in registry.fields("insights")}
    values = {
        "impressions": F.try_parse_json("impressions"),
        "spend": F.try_parse_json("spend"),
        "date_stop": F.col("date_stop").cast("variant"),
        "actions": F.col("actions"),
    }
    return fx.ads_raw(spark, sf_dir).select(
        F.col("_seq").alias("seq"),
        *(validate.value_conforms(by_name[n], v).alias(f"{n}_ok") for n, v in values.items()),
    )


def _fill(df: DataFrame, label: str, groups: dict[str, list[str]]) -> DataFrame:
    """Non-null values per group of columns, in one pass; one row per group."""
    totals = df.agg(
        *(
            sum((F.count(c) for c in columns), F.lit(0)).alias(f"n{i}")
            for i, columns in enumerate(groups.values())
        )
    )
    rows = [
        F.struct(F.lit(g).alias(label), F.lit(len(c)).cast("bigint").alias("n_columns"), F.col(f"n{i}").alias("n_values"))
        for i, (g, c) in enumerate(groups.items())
    ]
    return totals.select(F.inline(F.array(*rows)))


@query
def registry_schema(spark, sf_dir):
    fields = registry.fields("insights")
    filled = _fill(
        fx.valid_load(spark, sf_dir),
        "field",
        {f"{f.name} {f.data_type.simpleString()}": [f.name] for f in fields},
    )
    return filled.select("field", "n_values")


@query
def field_classes(spark, sf_dir):
    return _fill(fx.valid_load(spark, sf_dir), "class", registry.field_classes("insights"))


@query
def updatable_columns(spark, sf_dir):
    rows = upsert.read_table(spark, _loaded(spark, sf_dir, "updatable"))
    columns = registry.updatable_columns(rows)
    return _fill(rows, "column_name", {c: [c] for c in columns}).drop("n_columns")


@query
def mask_columns(spark, sf_dir):
    rows = fx.ads_raw(spark, sf_dir).select(
        F.col("_seq").alias("seq"), F.concat("account_id", "ad_id").alias("token"), "spend"
    )
    return text.mask_columns(rows, tail=("token",), full=("spend",))


@query
def normalize_account(spark, sf_dir):
    account = F.col("account_id")
    mixed = F.when(F.col("_seq") % 2 == 0, F.concat(F.lit("act_"), account)).otherwise(account)
    rows = fx.ads_raw(spark, sf_dir).select(F.col("_seq").alias("seq"), mixed.alias("given"))
    return rows.select(
        "seq",
        "given",
        with_account_prefix(F.col("given")).alias("api_id"),
        without_account_prefix(F.col("given")).alias("stored_id"),
    )


# -- structure profile -------------------------------------------------------------


@query
def profile_types(spark, sf_dir):
    found = profile.field_types(fx.raw_records(spark, sf_dir)).filter("kind = 'plain'")
    return profile.types_per_field(found).select("field", F.array_join("types", ",").alias("types"))


@query
def profile_nested(spark, sf_dir):
    return profile.nested_fields(profile.field_types(fx.raw_records(spark, sf_dir)))


@query
def profile_nested_values(spark, sf_dir):
    found = profile.field_types(fx.raw_records(spark, sf_dir)).filter("kind = 'values'")
    return profile.types_per_field(found).select("field", F.array_join("types", ",").alias("types"))


@query
def profile_summary(spark, sf_dir):
    rows = profile.record_summary(fx.raw_records(spark, sf_dir))
    return rows.select(
        "total_records", F.array_join("sample_record_keys", ",").alias("sample_record_keys")
    )


@query
def profile_merged(spark, sf_dir):
    """The states of two loads, stored one after the other, make the profile of all records."""
    path = run_folder(spark, "profile")
    records = fx.raw_records(spark, sf_dir, "load_no")
    for load in (1, 2):
        profile.store_state(records.filter(F.col("load_no") == load), path, load)
    keys = F.array_join(F.col("first.keys"), ",").alias("sample_record_keys")
    return profile.stored_profile(spark, path).select("field", "kind", "type", "n_records", keys)


# -- table writes ------------------------------------------------------------------


@query
def upsert_merge(spark, sf_dir):
    path = _loaded(spark, sf_dir, "upsert")
    upsert.upsert(fx.valid_load(spark, sf_dir, 2), path)
    return _flat(upsert.read_table(spark, path))


@query
def upsert_conflict(spark, sf_dir):
    """Two writers merge parts of the second load with the same version; both parts are kept."""
    path = run_folder(spark, "versions")
    versions.upsert(fx.valid_load(spark, sf_dir, 1), path)
    both = versions.load(spark, path)
    with staged(fx.valid_load(spark, sf_dir, 2), "writers") as rows:
        for parity in (0, 1):
            versions.upsert(rows.filter(F.expr(f"CAST(ad_id AS BIGINT) % 2 = {parity}")), path, base=both)
    return _flat(versions.read(spark, path))


@query
def upsert_bucketed(spark, sf_dir):
    path = run_folder(spark, "bucketed")
    for load in (1, 2):
        bucketed.upsert(fx.valid_load(spark, sf_dir, load), path, n_buckets=8)
    return _flat(bucketed.read(spark, path))


@query
def upsert_empty(spark, sf_dir):
    path = _loaded(spark, sf_dir, "upsert")
    nothing = fx.valid_load(spark, sf_dir, 2).filter("ad_id IS NULL")
    result = upsert.upsert(nothing, path)
    rows = _flat(upsert.read_table(spark, path))
    return rows.withColumn("status", F.lit(result["status"]))


@query
def merge_counts(spark, sf_dir):
    target = upsert.read_table(spark, _loaded(spark, sf_dir, "counts"))
    return upsert.merge_counts(target, stage(fx.valid_load(spark, sf_dir, 2), "merge-source"))


@query
def update_only(spark, sf_dir):
    path = _loaded(spark, sf_dir, "update")
    upsert.update_only(fx.valid_load(spark, sf_dir, 2), path)
    return _flat(upsert.read_table(spark, path))


@query
def append_rows(spark, sf_dir):
    path = _loaded(spark, sf_dir, "append")
    upsert.append_rows(fx.valid_load(spark, sf_dir, 2), path)
    return _flat(upsert.read_table(spark, path))


@query
def append_with_rejects(spark, sf_dir):
    path = run_folder(spark, "append")
    rejects = upsert.append_with_rejects(fx.landing_rows(spark, sf_dir), path)
    refused = rejects.select(
        F.get_json_object("record", "$.ad_id").alias("ad_id"),
        F.array_join("issues.code", ",").alias("outcome"),
    )
    stored = upsert.read_table(spark, path).select("ad_id", F.lit("stored").alias("outcome"))
    return refused.unionByName(stored).groupBy("ad_id", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query
def overwrite_then_append(spark, sf_dir):
    path = _loaded(spark, sf_dir, "staging")
    first, second = (fx.valid_load(spark, sf_dir, n) for n in (1, 2))
    upsert.overwrite_then_append(second, [first], path)
    return _flat(upsert.read_table(spark, path))


@query
def ensure_table(spark, sf_dir):
    path = run_folder(spark, "ensure")
    upsert.ensure_table(spark, path)
    upsert.append_rows(fx.valid_load(spark, sf_dir), path)
    upsert.ensure_table(spark, path)
    day = day_text(F.col("date_start")).alias("date_start")
    return upsert.read_table(spark, path).groupBy(day).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def schema_drift(spark, sf_dir):
    """Files of two ages: the first load has narrower counts, no spend, and a column of its own."""
    path = run_folder(spark, "drift")
    old = fx.valid_load(spark, sf_dir, 1).drop("spend").withColumns(
        {
            "impressions": F.col("impressions").cast("int"),
            "clicks": F.col("clicks").cast("int"),
            "actions": F.expr("transform(actions, a -> named_struct('value', int(a.value), 'action_type', a.action_type))"),
            "note": F.lit("of an earlier schema"),
        }
    )
    upsert.append_rows(old, path)
    upsert.append_rows(fx.valid_load(spark, sf_dir, 2), path)
    return _flat(drift.read_any_age(spark, path))


@query
def clone_schema(spark, sf_dir):
    source = upsert.read_table(spark, _loaded(spark, sf_dir, "clone-source"))
    clone = upsert.clone_schema(spark, source, run_folder(spark, "clone"))
    columns = [
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"))
        for f in clone.schema.fields
    ]
    counts = source.agg(F.count(F.lit(1)).alias("source_rows")).withColumn(
        "clone_rows", clone.agg(F.count(F.lit(1))).scalar()
    )
    return counts.select(F.inline(F.array(*columns)), "source_rows", "clone_rows")


@query
def route_table(spark, sf_dir):
    root = run_folder(spark, "route")
    out = None
    for name, load in (("daily", 1), ("other_set.daily_test", 2)):
        routed = upsert.route_table(name)
        path = f"{root}/{routed.replace('.', '/')}"
        upsert.append_rows(fx.valid_load(spark, sf_dir, load), path)
        count = upsert.read_table(spark, path).agg(F.count(F.lit(1)).alias("n_rows"))
        row = count.select(F.lit(routed).alias("target"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


@query
def quarantine(spark, sf_dir):
    path = run_folder(spark, "quarantine")
    checked = upsert.stage_checked(_checked(spark, sf_dir), registry.schema_for("insights"))
    jobs.write_quarantine(checked, path, "run-1")
    stored = spark.read.schema(f"record string, issues {validate.ISSUES}, run_id string").json(path)
    return stored.select(
        "run_id",
        F.get_json_object("record", "$.ad_id").alias("ad_id"),
        F.inline("issues"),
    )


@query
def existing_records(spark, sf_dir):
    target = upsert.read_table(spark, _loaded(spark, sf_dir, "existing"))
    batch = stage(fx.valid_load(spark, sf_dir, 2), "batch")
    found = upsert.existing_records(
        target, *(batch.select(k) for k in registry.LEGACY_KEYS)
    )
    return found.select(
        *(day_text(F.col(c)).alias(c) for c in ("date_start", "date_stop")), "ad_id"
    )


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    target = upsert.read_table(spark, _loaded(spark, sf_dir, "existing"))
    new = dedup.keep_latest(fx.ads_raw(spark, sf_dir).filter("load_no = 2"))
    return upsert.split_known(new, target)


@query
def split_updates(spark, sf_dir):
    return _raw(_split(spark, sf_dir)[0])


@query
def split_inserts(spark, sf_dir):
    return _raw(_split(spark, sf_dir)[1])


# -- KPI mappings ------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "conversions")
    fx.conversion_lines(spark, sf_dir).write.text(path)
    return conversions.read_documents(spark, path)


def _mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    custom = conversions.custom_mappings(_documents(spark, sf_dir))
    return kpi.all_mappings(fx.standard_seed(spark, sf_dir), custom, RUN_TS)


def _mapping_table(spark: SparkSession, sf_dir: str) -> str:
    path = run_folder(spark, "kpi")
    custom = conversions.custom_mappings(_documents(spark, sf_dir))
    kpi.refresh(fx.standard_seed(spark, sf_dir), custom, path, RUN_TS)
    return path


def _mapping_rows(df: DataFrame) -> DataFrame:
    written = F.to_utc_timestamp("last_updated", F.current_timezone())
    return df.select(
        *registry.schema_for("kpi_mapping").names[:-1],
        F.date_format(written, "yyyy-MM-dd HH:mm:ss").alias("last_updated"),
    )


@query
def custom_conversions(spark, sf_dir):
    return conversions.custom_mappings(_documents(spark, sf_dir))


@query
def failed_conversions(spark, sf_dir):
    failed = conversions.failed_documents(_documents(spark, sf_dir))
    return failed.groupBy(F.col("_corrupt_record").isNotNull().alias("corrupt")).agg(
        F.count(F.lit(1)).alias("n_documents")
    )


@query
def standard_mappings(spark, sf_dir):
    return fx.standard_seed(spark, sf_dir)


@query
def kpi_refresh(spark, sf_dir):
    return _mapping_rows(kpi.read_mappings(spark, _mapping_table(spark, sf_dir)))


@query
def kpi_full_scan(spark, sf_dir):
    return kpi.read_mappings(spark, _mapping_table(spark, sf_dir)).drop("last_updated")


@query
def kpi_projected_scan(spark, sf_dir):
    return kpi.lookup_columns(spark, _mapping_table(spark, sf_dir))


@query
def mapping_summary(spark, sf_dir):
    return kpi.summary(_mappings(spark, sf_dir))


@query
def kpi_counts(spark, sf_dir):
    return kpi.origin_counts(_mappings(spark, sf_dir))


@query
def kpi_latest(spark, sf_dir):
    seed = fx.standard_seed(spark, sf_dir)
    older = kpi.all_mappings(
        seed.withColumn("meta_action_type", F.concat(F.lit("zz."), "meta_action_type")),
        None,
        datetime(2024, 1, 1, tzinfo=timezone.utc),
    )
    return kpi.latest(older.unionByName(_mappings(spark, sf_dir)))


@query
def kpi_resolve(spark, sf_dir):
    requests = fx.ads_raw(spark, sf_dir).select(
        F.col("_seq").alias("seq"),
        F.col("account_id").alias("ad_account_id"),
        F.col("event_type").alias("kpi_name"),
    )
    return kpi.resolve(requests, kpi.read_mappings(spark, _mapping_table(spark, sf_dir)))


# -- jobs --------------------------------------------------------------------------


def _config(spark: SparkSession, label: str, **options) -> jobs.SyncConfig:
    return jobs.SyncConfig(
        root=run_folder(spark, label), accounts=fx.ACCOUNTS, validate=True, **options
    )


def _synced(spark: SparkSession, sf_dir: str, run: Callable) -> DataFrame:
    """Run a job on a table that holds the first load; return the table."""
    config = _config(spark, "sync", update_kpis=False)
    path = config.path_of(config.table)
    upsert.append_rows(fx.valid_load(spark, sf_dir, 1), path)
    run(config, fx.landing_rows(spark, sf_dir))
    return _flat(upsert.read_table(spark, path))


@query
def full_sync(spark, sf_dir):
    return _synced(spark, sf_dir, lambda c, rows: jobs.sync(spark, c, rows, as_of=fx.AS_OF))


@query
def incremental_sync(spark, sf_dir):
    return _synced(
        spark, sf_dir, lambda c, rows: jobs.incremental_sync(spark, c, rows, as_of="2024-01-30")
    )


@query
def stream_sync(spark, sf_dir):
    """The first load lands and is taken in; then the second one, of which only new files are read."""
    path, checkpoint = run_folder(spark, "landing"), run_folder(spark, "stream-checkpoint")
    config = _config(spark, "stream")
    for load in (1, 2):
        fx.write_landing(spark, sf_dir, path, load=load)
        stream.stream_sync(spark, config, path, checkpoint, schema=fx.landing_schema())
    return _flat(versions.read(spark, config.path_of(config.table)))


@query
def date_range_sync(spark, sf_dir):
    return _synced(
        spark,
        sf_dir,
        lambda c, rows: jobs.date_range_sync(spark, c, rows, "2024-01-05", fx.UNTIL),
    )


@query
def validate_only(spark, sf_dir):
    config = _config(spark, "validate")
    report = jobs.validate_only(spark, config, fx.landing_rows(spark, sf_dir), as_of=fx.AS_OF)
    return jobs.report_frame(spark, report).select(
        "status", "total_records", "valid_records", "invalid_records", "upload_status"
    )


@query
def landing_sync(spark, sf_dir):
    """From JSON lines to the table in one call, with mapping refresh and quarantine."""
    path = run_folder(spark, "landing")
    fx.write_landing(spark, sf_dir, path)
    config = _config(spark, "landing-sync")
    custom = conversions.custom_mappings(_documents(spark, sf_dir))
    jobs.sync_landing(spark, config, path, fx.SINCE, fx.UNTIL, custom=custom)
    return _flat(upsert.read_table(spark, config.path_of(config.table)))


@query
def sync_faults(spark, sf_dir):
    """Missing and unparsable days and lines that are not JSON are counted and kept."""
    path = run_folder(spark, "faults")
    fx.faulty_lines(spark, sf_dir).write.text(path)
    config = _config(spark, "faults", update_kpis=False)
    report = jobs.sync_landing(spark, config, path, "2024-01-01", "9999-12-31")
    kept = spark.read.schema(f"record string, issues {validate.ISSUES}").json(config.quarantine)
    counts = "total_records", "valid_records", "invalid_records", "corrupt_lines", "processed"
    return jobs.report_frame(spark, report).select(
        *counts, kept.agg(F.count(F.lit(1))).scalar().alias("quarantined")
    )


@query
def run_report(spark, sf_dir):
    mapping = {"user_friendly_name": "lead", "meta_action_type": "lead", "mapping_type": "standard", "ad_account_id": "all"}
    config = _config(
        spark, "report", quarantine_path=run_folder(spark, "quarantine"), standard_mappings=[mapping]
    )
    custom = conversions.custom_mappings(_documents(spark, sf_dir))
    report = jobs.sync(
        spark, config, fx.landing_rows(spark, sf_dir), as_of=fx.AS_OF, custom=custom
    )
    return jobs.report_frame(spark, report).drop(
        "run_id", "start_time", "end_time", "duration_seconds", "error", "files_listed", "files_skipped"
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan, deduplicate, check and cast: the read side of a full sync."""
    rows = landing.scan_range(
        fx.landing_rows(spark, sf_dir), fx.ACCOUNTS, fx.SINCE, fx.UNTIL
    )
    return _flat(validate.valid_rows(jobs.prepared(rows)))
