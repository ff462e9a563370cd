"""The same results in plain SQL, for a second engine to check the queries against.

Written from the rules, not from the Spark code: every statement starts from the driver's
tables through the shared adapter text.
"""

from __future__ import annotations

from adledger import registry
from adledger.plans.fixtures import ADS_RAW, ACCOUNTS, AS_OF, SINCE, UNTIL

_INT = "[+-]?[0-9]+"
_FLOAT = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
_LATEST = "ORDER BY coalesce(date_stop, '') DESC, seq"
_IN = ", ".join(f"'{a}'" for a in ACCOUNTS)

# ads: the adapter. judged: parsed values and verdicts of each row. The rest are the
# deduplicated tables that several statements use.
_WITH = f"""
WITH ads AS ({ADS_RAW}),
listed AS (
  SELECT *,
    CASE WHEN json_type(actions_json) = 'ARRAY'
         THEN CAST(json_extract(actions_json, '$[*]') AS JSON[]) END AS items
  FROM ads),
parsed AS (
  SELECT *,
    CASE WHEN regexp_full_match(trim(impressions), '{_INT}') THEN TRY_CAST(trim(impressions) AS BIGINT) END AS t_impressions,
    CASE WHEN regexp_full_match(trim(clicks), '{_INT}') THEN TRY_CAST(trim(clicks) AS BIGINT) END AS t_clicks,
    CASE WHEN regexp_full_match(trim(spend), '{_FLOAT}') THEN TRY_CAST(trim(spend) AS DOUBLE) END AS t_spend,
    TRY_CAST(date_stop AS DATE) AS t_date_stop,
    actions_json IS NOT NULL AND items IS NULL AS not_list,
    coalesce(len(list_filter(items, lambda x: json_type(x) <> 'OBJECT')), 0) AS n_not_object,
    coalesce(len(list_filter(items, lambda x: json_type(x) = 'OBJECT'
      AND (json_type(x, '$.action_type') IS NULL OR json_type(x, '$.value') IS NULL))), 0) AS n_missing,
    coalesce(len(list_filter(items, lambda x: json_type(x, '$.value') <> 'NULL'
      AND NOT regexp_full_match(json_extract_string(x, '$.value'), '{_INT}'))), 0) AS n_lost
  FROM listed),
judged AS (
  SELECT *, NOT bad AND n_lost = 0 AS ok,
    CASE WHEN bad THEN NULL ELSE coalesce(len(items), 0) END AS n_actions,
    CASE WHEN bad THEN NULL ELSE coalesce(CAST(list_sum(list_transform(items,
      lambda x: TRY_CAST(json_extract_string(x, '$.value') AS BIGINT))) AS BIGINT), 0) END AS action_sum
  FROM (SELECT *,
      (impressions IS NOT NULL AND t_impressions IS NULL) OR (clicks IS NOT NULL AND t_clicks IS NULL)
      OR (spend IS NOT NULL AND t_spend IS NULL) OR (date_stop IS NOT NULL AND t_date_stop IS NULL)
      OR not_list OR n_not_object > 0 OR n_missing > 0 AS bad
    FROM parsed)),
latest AS (
  SELECT * FROM judged
  QUALIFY row_number() OVER (PARTITION BY ad_id, date_start, account_id {_LATEST}) = 1),
loads AS (
  SELECT * FROM (
    SELECT * FROM judged
    QUALIFY row_number() OVER (PARTITION BY load_no, ad_id, date_start, account_id {_LATEST}) = 1)
  WHERE ok),
load1 AS (SELECT * FROM loads WHERE load_no = 1),
load2 AS (SELECT * FROM loads WHERE load_no = 2),
rawload2 AS (
  SELECT * FROM judged WHERE load_no = 2
  QUALIFY row_number() OVER (PARTITION BY ad_id, date_start, account_id {_LATEST}) = 1)
"""

_RAW = "seq, account_id, ad_id, date_start, date_stop, impressions, clicks, spend"
_FLAT = (
    "account_id, ad_id, date_start, CAST(t_date_stop AS VARCHAR) AS date_stop, "
    "t_impressions AS impressions, t_clicks AS clicks, t_spend AS spend, n_actions, action_sum"
)
_SAME_KEY = "s.ad_id = t.ad_id AND s.account_id = t.account_id AND s.date_start = t.date_start"
_OLD_KEY = "s.ad_id = t.ad_id AND s.date_stop = t.date_stop AND s.date_start = t.date_start"


def _ads(sql: str) -> str:
    return f"{_WITH} {sql}"


def _windows(days: int) -> str:
    """Window starts and ends of ranges (first, last) in a relation ``days``."""
    return (
        f"SELECT *, least(s + {days - 1}, last) AS e FROM (SELECT *, "
        f"CAST(unnest(generate_series(first, last, INTERVAL {days - 1} DAY)) AS DATE) AS s FROM days)"
    )


def _in_range(since: str, until: str) -> str:
    return f"date_start BETWEEN '{since}' AND '{until}' AND account_id IN ({_IN})"


def _upserted(source: str) -> str:
    """The first load with a source merged into it."""
    return _ads(
        f"SELECT {_FLAT} FROM load1 t WHERE NOT EXISTS (SELECT 1 FROM ({source}) s WHERE {_SAME_KEY}) "
        f"UNION ALL SELECT {_FLAT} FROM ({source})"
    )


def _synced(since: str, until: str) -> str:
    return _upserted(f"SELECT * FROM latest WHERE ok AND {_in_range(since, until)}")


# -- statements of several lines ---------------------------------------------------

_CHUNK_SCAN = f"""
, days AS (SELECT DATE '{SINCE}' AS first, DATE '{UNTIL}' AS last), plan AS ({_windows(7)}),
hits AS (
  SELECT seq, account_id, date_start, CAST(s AS VARCHAR) AS since, CAST(e AS VARCHAR) AS until
  FROM ads JOIN plan ON CAST(date_start AS DATE) BETWEEN s AND e WHERE account_id IN ({_IN}))
"""

_ITEMS = "(SELECT *, unnest(items) AS item, unnest(range(len(items))) AS idx FROM parsed WHERE items IS NOT NULL)"
_ISSUES = f"""
SELECT seq, 'bad_value' AS code, 'impressions' AS field, CAST(NULL AS INTEGER) AS idx, impressions AS value
  FROM parsed WHERE impressions IS NOT NULL AND t_impressions IS NULL
UNION ALL SELECT seq, 'bad_value', 'spend', NULL, spend FROM parsed WHERE spend IS NOT NULL AND t_spend IS NULL
UNION ALL SELECT seq, 'bad_value', 'date_stop', NULL, date_stop FROM parsed WHERE date_stop IS NOT NULL AND t_date_stop IS NULL
UNION ALL SELECT seq, 'not_list', 'actions', NULL, actions_json FROM parsed WHERE not_list
UNION ALL SELECT seq, CASE WHEN json_type(item) <> 'OBJECT' THEN 'not_object' ELSE 'missing_keys' END,
  'actions', CAST(idx AS INTEGER), CAST(item AS VARCHAR) FROM {_ITEMS}
  WHERE json_type(item) <> 'OBJECT' OR json_type(item, '$.action_type') IS NULL OR json_type(item, '$.value') IS NULL
"""
_LOST = "SELECT seq, 'transformation_failed', NULL, NULL, NULL FROM judged WHERE NOT bad AND NOT ok"

_LATE = "seq > (SELECT max(event_id) / 2 FROM events)"

_MATCHED = f"(SELECT count(*) FROM load2 s WHERE EXISTS (SELECT 1 FROM load1 t WHERE {_SAME_KEY}))"

_PLAIN_TYPES = "UNION ALL".join(
    [" SELECT 'seq' AS field, 'int' AS type FROM ads "]
    + [
        f" SELECT '{c}', CASE WHEN {c} IS NULL THEN 'NoneType' ELSE 'str' END FROM ads "
        for c in "account_id ad_id date_start date_stop impressions clicks spend".split()
    ]
    + [
        " SELECT 'actions', CASE WHEN actions_json IS NULL THEN 'NoneType' WHEN items IS NULL "
        "THEN 'str' ELSE 'list' END FROM parsed WHERE items IS NULL OR len(items) = 0 OR n_not_object > 0 "
    ]
)

_FILLED = """
filled AS (SELECT count(*) AS n, count(t_date_stop) AS n_stop, count(t_impressions) AS n_imp,
  count(t_clicks) AS n_clicks, count(t_spend) AS n_spend,
  count(CASE WHEN n_actions > 0 THEN 1 END) AS n_act FROM {rows})
"""
_FILL_OF = {
    "account_id": "n", "ad_id": "n", "date_start": "n", "date_stop": "n_stop",
    "impressions": "n_imp", "clicks": "n_clicks", "spend": "n_spend", "actions": "n_act",
}


def _filled(rows: str, label: str, entries: dict[str, str]) -> str:
    """One row per entry (name -> count expression over ``filled``)."""
    union = " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, {n} AS n_values FROM filled" for name, n in entries.items()
    )
    return _ads("," + _FILLED.format(rows=rows) + union)


_FIELD_TYPES = {f.name: f.data_type.simpleString() for f in registry.fields("insights")}
_CLASS_FILL = {
    "float": (9, "n_spend"), "int": (5, "n_imp + n_clicks"), "date": (2, "n + n_stop"),
    "str": (14, "2 * n"), "nested": (12, "n_act"),
}

def _class_oracle() -> str:
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS class, CAST({k} AS BIGINT) AS n_columns, {n} AS n_values FROM filled"
        for c, (k, n) in _CLASS_FILL.items()
    )
    return _ads("," + _FILLED.format(rows="(SELECT * FROM latest WHERE ok)") + union)


# The documents of a nation and id range, and what was planted in them.
_CUSTOM = """
docs AS (SELECT *, (c_nationkey + c_custkey // 400) % 7 AS kind FROM customer),
custom AS (SELECT c_name AS user_friendly_name, concat('offsite_conversion.custom.', c_custkey) AS meta_action_type,
  'custom' AS mapping_type, CAST(c_nationkey AS VARCHAR) AS ad_account_id,
  CAST(c_custkey AS VARCHAR) AS facebook_conversion_id FROM docs WHERE kind < 4)
"""
_STANDARD = """
kinds AS (SELECT DISTINCT event_type AS e FROM events),
standard AS (
  SELECT e AS user_friendly_name, concat('any.', e) AS meta_action_type, 'standard' AS mapping_type,
    'all' AS ad_account_id FROM kinds WHERE e <> 'error'
  UNION ALL SELECT e, concat('own.', e), 'standard', '900' FROM kinds WHERE e IN ('click', 'purchase'))
"""
_MAPPINGS = f"""WITH {_CUSTOM}, {_STANDARD},
mappings AS (SELECT *, NULL AS facebook_conversion_id, 'standard' AS origin FROM standard
  UNION ALL SELECT *, 'custom' FROM custom)
"""

ORACLES: dict[str, str] = {
    "scan_date_range": _ads(f"SELECT {_RAW} FROM latest WHERE {_in_range(SINCE, UNTIL)}"),
    "open_range": _ads(f"SELECT {_RAW} FROM latest WHERE {_in_range('2024-01-10', '9999-12-31')}"),
    "scan_last_30d": _ads(
        f"SELECT {_RAW} FROM latest WHERE account_id IN ({_IN}) AND CAST(date_start AS DATE) "
        f"BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}' - 1"
    ),
    "chunk_plan": "WITH days AS (SELECT min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last "
    f"FROM events), plan AS ({_windows(7)}) "
    "SELECT CAST(s AS VARCHAR) AS since, CAST(e AS VARCHAR) AS until FROM plan",
    "chunk_account_plan": "WITH days AS (SELECT CAST(900 + user_id % 5 AS VARCHAR) AS account_id, "
    "min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last FROM events GROUP BY 1), "
    f"plan AS ({_windows(5)}) "
    "SELECT account_id, CAST(s AS VARCHAR) AS since, CAST(e AS VARCHAR) AS until FROM plan",
    "chunk_scan": _ads(f"{_CHUNK_SCAN} SELECT * FROM hits"),
    "plan_scan": _ads(
        ", days AS (SELECT account_id AS acc, CAST(account_id AS INT) - 898 AS step, CAST(min(date_start) AS DATE) AS first, "
        "CAST(max(date_start) AS DATE) AS last FROM ads GROUP BY account_id), plan AS (SELECT acc, step, last, "
        "CAST(unnest(generate_series(first, last, to_days(step))) AS DATE) AS s FROM days) "
        "SELECT seq, account_id, date_start, CAST(s AS VARCHAR) AS since, CAST(least(s + step, last) AS VARCHAR) AS until "
        f"FROM ads JOIN plan ON account_id = acc AND CAST(date_start AS DATE) BETWEEN s AND least(s + step, last) WHERE acc IN ({_IN})"
    ),
    "scan_counts": _ads(
        f"{_CHUNK_SCAN} SELECT account_id, since, count(*) AS n_rows FROM hits GROUP BY account_id, since"
    ),
    "scan_skips_bad_account": _ads(
        "SELECT a AS account_id, count(CASE WHEN NOT cut THEN 1 END) AS n_rows, "
        "CAST(0 AS BIGINT) AS n_without_ad, count(CASE WHEN cut THEN 1 END) AS n_corrupt, CASE WHEN count(cut) = 0 THEN 'missing' "
        "WHEN count(CASE WHEN cut THEN 1 END) > 0 THEN 'corrupt' ELSE 'ok' END AS status "
        f"FROM (SELECT unnest([{_IN}, '999']) AS a) w LEFT JOIN "
        "(SELECT account_id, account_id = '904' AND seq % 97 = 0 AS cut FROM ads) r ON a = account_id GROUP BY a"
    ),
    "scan_skips_bad_file": _ads(
        "SELECT account_id, count(*) AS n_rows, CAST(account_id = '904' AS BIGINT) AS files_skipped FROM ads GROUP BY account_id"
    ),
    "incremental_window": _ads(
        f"SELECT {_RAW} FROM ads WHERE {_in_range('2024-01-23', '2024-01-30')}"
    ),
    "ad_listing": _ads("SELECT ad_id FROM (SELECT DISTINCT account_id, ad_id FROM ads)"),
    "project_fields": _ads(f"SELECT {_RAW} FROM ads"),
    "run_sql": _ads(
        "SELECT account_id, event_type, count(*) AS n FROM ads WHERE event_type IN "
        f"('click', 'view', 'purchase') AND date_start BETWEEN '{SINCE}' AND '{UNTIL}' "
        "GROUP BY account_id, event_type"
    ),
    "dedup_latest": _ads(f"SELECT {_RAW} FROM latest"),
    "dedup_stats": _ads(
        "SELECT (SELECT count(*) FROM ads) AS n_in, (SELECT count(*) FROM latest) AS n_out, "
        "(SELECT count(*) FROM ads) - (SELECT count(*) FROM latest) AS n_removed"
    ),
    "existing_keys": _ads("SELECT DISTINCT date_start, date_stop, ad_id FROM ads"),
    "validate_issues": _ads(_ISSUES),
    "cast_typed": _ads(
        "SELECT account_id, ad_id, date_start, CAST(t_date_stop AS VARCHAR) AS date_stop, "
        "t_impressions AS impressions, t_clicks AS clicks, t_spend AS spend FROM judged WHERE ok"
    ),
    "cast_nested": _ads(
        "SELECT seq, json_extract_string(item, '$.action_type') AS action_type, "
        "TRY_CAST(json_extract_string(item, '$.value') AS BIGINT) AS value "
        "FROM (SELECT seq, unnest(items) AS item FROM judged WHERE ok)"
    ),
    "split_valid": _ads(f"SELECT {_FLAT} FROM latest WHERE ok"),
    "split_invalid": _ads(
        ", issues AS (" + _ISSUES + f" UNION ALL {_LOST}) "
        "SELECT l.seq, l.ad_id, (SELECT string_agg(i.code, ',' ORDER BY CASE i.field WHEN 'spend' THEN 1 "
        "WHEN 'impressions' THEN 2 WHEN 'date_stop' THEN 3 ELSE 4 END, i.idx) FROM issues i WHERE i.seq = l.seq) AS codes "
        "FROM latest l WHERE NOT l.ok"
    ),
    "stop_first_error": _ads(
        f", late AS (SELECT * FROM judged WHERE NOT bad OR {_LATE}) SELECT seq, ok FROM late "
        "WHERE seq <= (SELECT min(seq) FROM late WHERE bad) OR (SELECT min(seq) FROM late WHERE bad) IS NULL"
    ),
    "validation_counts": _ads(
        "SELECT count(*) AS total_records, count(CASE WHEN ok THEN 1 END) AS valid_records, "
        "count(CASE WHEN NOT ok THEN 1 END) AS invalid_records FROM judged"
    ),
    "field_conforms": _ads(
        "SELECT seq, CASE WHEN impressions = '1.0' THEN false ELSE true END AS impressions_ok, "
        f"CASE WHEN spend IS NULL OR TRY_CAST(spend AS DOUBLE) IS NULL THEN true "
        f"ELSE NOT regexp_full_match(spend, '{_INT}') END AS spend_ok, true AS date_stop_ok, "
        "actions_json IS NULL OR json_type(actions_json) = 'ARRAY' AS actions_ok FROM ads"
    ),
    "registry_schema": _filled(
        "(SELECT * FROM latest WHERE ok)",
        "field",
        {f"{n} {t}": _FILL_OF.get(n, "0") for n, t in _FIELD_TYPES.items()},
    ),
    "field_classes": _class_oracle(),
    "updatable_columns": _filled(
        "load1",
        "column_name",
        {
            n: _FILL_OF.get(n, "0")
            for n in _FIELD_TYPES
            if n not in ("date_start", "date_stop", "ad_id")
        },
    ),
    "mask_columns": _ads(
        "SELECT seq, right(concat(account_id, ad_id), 4) AS token, '***' AS spend FROM ads"
    ),
    "normalize_account": _ads(
        "SELECT seq, CASE WHEN seq % 2 = 0 THEN concat('act_', account_id) ELSE account_id END AS given, "
        "concat('act_', account_id) AS api_id, account_id AS stored_id FROM ads"
    ),
    "profile_types": _ads(
        f", found AS ({_PLAIN_TYPES}) SELECT field, string_agg(DISTINCT type, ',' ORDER BY type) AS types "
        "FROM found GROUP BY field"
    ),
    "profile_nested": _ads(
        "SELECT DISTINCT 'actions' AS field FROM parsed WHERE len(items) > 0 AND json_type(items[1]) = 'OBJECT'"
    ),
    "profile_nested_values": _ads(
        "SELECT 'actions_values' AS field, string_agg(DISTINCT type, ',' ORDER BY type) AS types FROM ("
        "SELECT CASE json_type(item, '$.value') WHEN 'NULL' THEN 'NoneType' WHEN 'VARCHAR' THEN 'str' "
        f"ELSE 'other' END AS type FROM {_ITEMS} WHERE json_type(item, '$.action_type') IS NOT NULL "
        "AND json_type(item, '$.value') IS NOT NULL) HAVING count(*) > 0"
    ),
    "profile_merged": _ads(
        f", found AS ({_PLAIN_TYPES}), vals AS (SELECT seq, CASE json_type(item, '$.value') WHEN 'NULL' THEN 'NoneType' "
        f"WHEN 'VARCHAR' THEN 'str' ELSE 'other' END AS type FROM {_ITEMS} WHERE json_type(item, '$.action_type') IS NOT NULL "
        "AND json_type(item, '$.value') IS NOT NULL AND json_type(items[1]) = 'OBJECT') "
        "SELECT field, 'plain' AS kind, type, count(*) AS n_records, NULL AS sample_record_keys FROM found GROUP BY field, type "
        "UNION ALL SELECT 'actions', 'nested', 'list', count(*), NULL FROM parsed WHERE len(items) > 0 "
        "AND json_type(items[1]) = 'OBJECT' HAVING count(*) > 0 "
        "UNION ALL SELECT 'actions_values', 'values', type, count(DISTINCT seq), NULL FROM vals GROUP BY type "
        "UNION ALL SELECT NULL, 'records', NULL, count(*), 'seq,account_id,ad_id,date_start,date_stop,impressions,clicks,"
        "spend,actions' FROM ads HAVING count(*) > 0"
    ),
    "profile_summary": "SELECT count(*) AS total_records, 'seq,account_id,ad_id,date_start,date_stop,"
    "impressions,clicks,spend,actions' AS sample_record_keys FROM events",
    "upsert_merge": _upserted("SELECT * FROM load2"),
    "upsert_conflict": _upserted("SELECT * FROM load2"),
    "upsert_bucketed": _upserted("SELECT * FROM load2"),
    "stream_sync": _upserted("SELECT * FROM load2"),
    "upsert_empty": _ads(f"SELECT {_FLAT}, 'no_records' AS status FROM load1"),
    "merge_counts": _ads(
        f"SELECT count(*) AS processed, {_MATCHED} AS updated, count(*) - {_MATCHED} AS inserted, "
        "count(*) AS rows_affected FROM load2"
    ),
    "update_only": _ads(
        f"SELECT {_FLAT} FROM load1 t WHERE NOT EXISTS (SELECT 1 FROM load2 s WHERE {_OLD_KEY}) "
        f"UNION ALL SELECT {_FLAT} FROM load2 s WHERE EXISTS (SELECT 1 FROM load1 t WHERE {_OLD_KEY})"
    ),
    "append_rows": _ads(f"SELECT {_FLAT} FROM loads"),
    "append_with_rejects": _ads(
        ", issues AS (" + _ISSUES + f" UNION ALL {_LOST}), per_row AS (SELECT seq, string_agg(code, ',' "
        "ORDER BY CASE field WHEN 'spend' THEN 1 WHEN 'impressions' THEN 2 WHEN 'date_stop' THEN 3 ELSE 4 END, idx) "
        "AS codes FROM issues GROUP BY seq) "
        "SELECT ad_id, coalesce(codes, 'stored') AS outcome, count(*) AS n "
        "FROM judged LEFT JOIN per_row USING (seq) GROUP BY 1, 2"
    ),
    "overwrite_then_append": _ads(f"SELECT {_FLAT} FROM loads"),
    "ensure_table": _ads(
        "SELECT date_start, count(*) AS n_rows FROM latest WHERE ok GROUP BY date_start"
    ),
    "schema_drift": _ads(
        f"SELECT * REPLACE (CAST(NULL AS DOUBLE) AS spend) FROM (SELECT {_FLAT} FROM load1) UNION ALL SELECT {_FLAT} FROM load2"
    ),
    "clone_schema": _ads(
        ", columns AS (SELECT * FROM (VALUES "
        + ", ".join(f"('{n}', '{t}')" for n, t in _FIELD_TYPES.items())
        + ") v(column_name, data_type)) SELECT column_name, data_type, "
        "(SELECT count(*) FROM load1) AS source_rows, CAST(0 AS BIGINT) AS clone_rows FROM columns"
    ),
    "route_table": _ads(
        "SELECT CASE load_no WHEN 1 THEN 'ads.daily' ELSE 'other_set.daily_test' END AS target, "
        "count(*) AS n_rows FROM loads GROUP BY load_no"
    ),
    "quarantine": _ads(
        ", issues AS (" + _ISSUES + f" UNION ALL {_LOST}) SELECT 'run-1' AS run_id, ad_id, code, field, idx, value "
        "FROM issues JOIN ads USING (seq)"
    ),
    "existing_records": _ads(
        "SELECT date_start, date_stop, ad_id FROM load1 WHERE date_start IN (SELECT date_start FROM load2) "
        "AND date_stop IN (SELECT date_stop FROM load2) AND ad_id IN (SELECT ad_id FROM load2)"
    ),
    "split_updates": _ads(
        f"SELECT {_RAW} FROM rawload2 s WHERE EXISTS (SELECT 1 FROM load1 t WHERE {_OLD_KEY})"
    ),
    "split_inserts": _ads(
        f"SELECT {_RAW} FROM rawload2 s WHERE NOT EXISTS (SELECT 1 FROM load1 t WHERE {_OLD_KEY})"
    ),
    "custom_conversions": f"WITH {_CUSTOM} SELECT * FROM custom",
    "failed_conversions": f"WITH {_CUSTOM} SELECT kind = 5 AS corrupt, "
    "count(DISTINCT (c_nationkey, c_custkey // 400)) AS n_documents FROM docs WHERE kind IN (5, 6) GROUP BY kind",
    "standard_mappings": f"WITH {_STANDARD} SELECT * FROM standard",
    "kpi_refresh": f"{_MAPPINGS} SELECT user_friendly_name, meta_action_type, mapping_type, ad_account_id, "
    "facebook_conversion_id, '2024-02-01 12:00:00' AS last_updated FROM mappings",
    "kpi_full_scan": f"{_MAPPINGS} SELECT user_friendly_name, meta_action_type, mapping_type, ad_account_id, "
    "facebook_conversion_id FROM mappings",
    "kpi_projected_scan": f"{_MAPPINGS} SELECT ad_account_id, user_friendly_name, meta_action_type FROM mappings",
    "mapping_summary": f"{_MAPPINGS} SELECT ad_account_id, mapping_type, count(*) AS count FROM mappings "
    "GROUP BY ad_account_id, mapping_type",
    "kpi_counts": f"{_MAPPINGS} SELECT count(CASE WHEN origin = 'standard' THEN 1 END) AS standard, "
    "count(CASE WHEN origin = 'custom' THEN 1 END) AS custom, count(*) AS total FROM mappings",
    "kpi_latest": f"{_MAPPINGS} SELECT concat(ad_account_id, ':', user_friendly_name) AS mapping_key, "
    "max(meta_action_type) AS meta_action_type FROM mappings GROUP BY 1",
    "kpi_resolve": f"{_MAPPINGS}, asked AS (SELECT event_id AS seq, CAST(900 + user_id % 5 AS VARCHAR) AS ad_account_id, "
    "event_type AS kpi_name FROM events) SELECT seq, r.ad_account_id, kpi_name, "
    "coalesce(own.meta_action_type, shared.meta_action_type) AS meta_action_type FROM asked r "
    "LEFT JOIN mappings own ON own.ad_account_id = r.ad_account_id AND own.user_friendly_name = kpi_name "
    "LEFT JOIN mappings shared ON shared.ad_account_id = 'all' AND shared.user_friendly_name = kpi_name",
    "full_sync": _synced("2024-01-01", "2024-01-30"),
    "incremental_sync": _synced("2024-01-23", "2024-01-30"),
    "date_range_sync": _synced("2024-01-05", UNTIL),
    "landing_sync": _ads(f"SELECT {_FLAT} FROM latest WHERE ok AND {_in_range(SINCE, UNTIL)}"),
    "sync_faults": (
        _WITH.replace(ADS_RAW, f"""SELECT * REPLACE (CASE WHEN seq % 97 = 0 THEN NULL WHEN seq % 101 = 0 THEN 'n/a'
            ELSE date_start END AS date_start) FROM ({ADS_RAW}) WHERE seq % 103 <> 0 AND account_id IN ({_IN})""")
        + f""", cut AS (SELECT count(*) AS n FROM ({ADS_RAW}) WHERE seq % 103 = 0 AND account_id IN ({_IN})),
        seen AS (SELECT ok AND coalesce(date_start, '') <> 'n/a' AS fits FROM latest)
        SELECT count(*) + any_value(cut.n) AS total_records, count(CASE WHEN fits THEN 1 END) AS valid_records,
            count(CASE WHEN NOT fits THEN 1 END) + any_value(cut.n) AS invalid_records,
            any_value(cut.n) AS corrupt_lines, count(CASE WHEN fits THEN 1 END) AS processed,
            count(CASE WHEN NOT fits THEN 1 END) + any_value(cut.n) AS quarantined
        FROM seen, cut"""
    ),
    "validate_only": _ads(
        "SELECT 'completed' AS status, count(*) AS total_records, count(CASE WHEN ok THEN 1 END) AS valid_records, "
        "count(CASE WHEN NOT ok THEN 1 END) AS invalid_records, 'skipped' AS upload_status FROM latest"
    ),
    "run_report": _ads(
        "," + _CUSTOM + "SELECT 'completed' AS status, 'success' AS kpi_status, "
        "1 + (SELECT count(*) FROM custom) AS mappings, count(*) AS total_records, 0 AS corrupt_lines, "
        "'success' AS validation_status, count(CASE WHEN ok THEN 1 END) AS valid_records, "
        "count(CASE WHEN NOT ok THEN 1 END) AS invalid_records, 'success' AS upload_status, "
        "count(CASE WHEN ok THEN 1 END) AS processed, count(CASE WHEN ok THEN 1 END) AS rows_affected FROM latest"
    ),
}

