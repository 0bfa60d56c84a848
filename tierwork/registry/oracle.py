"""The same queries as SQL for DuckDB, over the views of ``shapes``."""

from __future__ import annotations

from tierwork.registry.shapes import COLUMNS, INCIDENT_SQL, SNAPSHOT_SQL

C = ", ".join(COLUMNS)
# Fixed values, written down once more so that the SQL does not lean on the code it checks.
CRITICAL = ("Number", "Category", "Priority", "State")
DEFAULTS = {
    "short_description": "No Description",
    "Caller": "Unknown",
    "User_ID": "Unknown",
    "Assignment_Group": "Unassigned",
    "Assigned_To": "Unassigned",
    "Channel": "Unknown",
    "Service": "Unknown",
    "Service_Family": "Unknown",
    "Service_Subcategory": "Unknown",
    "Updated_By": "Unknown",
}
SPACED = {
    "User_ID": "User_ID",
    "Assignment_Group": "Assignment_group_name",
    "Assigned_To": "Assigned_to_name",
    "Service_Family": "Service_Family",
    "Service_Subcategory": "Service_Subcategory",
    "Updated_By": "Updated_by",
}


def text_date(name: str) -> str:
    return f"strftime({name}, '%d-%m-%Y %H:%M')"


TEXT_DATES = ", ".join(
    f"{text_date(c)} AS {c}" if c in ("Opened", "Updated") else c for c in COLUMNS
)
HOURS = "round((epoch(Updated) - epoch(Opened)) / 3600, 2)"
REASON = "CASE " + " ".join(f"WHEN {c} IS NULL THEN 'null in {c}'" for c in CRITICAL) + " END"
ANY_NULL = " OR ".join(f"{c} IS NULL" for c in CRITICAL)
FILLED = ", ".join(
    f"coalesce({c}, '{DEFAULTS[c]}') AS {c}" if c in DEFAULTS else c for c in COLUMNS
)
WITH = f"WITH {INCIDENT_SQL}"
ROUTED = f"""{WITH},
numbered AS (SELECT {C}, row_number() OVER (PARTITION BY {C}) AS rn FROM inc),
routed AS (
  SELECT {C}, CASE WHEN rn > 1 THEN 'duplicate row' ELSE {REASON} END AS reject_reason FROM numbered)"""
SILVER = f"""{ROUTED},
silver AS (SELECT {FILLED} FROM routed WHERE reject_reason IS NULL)"""
BY_KEY = f"""{WITH},
ranked AS (SELECT {C}, row_number() OVER (PARTITION BY User_ID, Opened ORDER BY {", ".join(
    f"{c} NULLS FIRST" for c in ("Updated", "Number", *COLUMNS))}) AS rn FROM inc)"""
SNAP = f"WITH {SNAPSHOT_SQL}"


def percent(part: str, total: str) -> str:
    return f"round({part} / {total} * 100, 2)"


def check(kind: str, label: str, value: str, share: str, state: str) -> str:
    return (
        f"SELECT '{kind}' AS check_type, '{label}' AS column_name, CAST({value} AS VARCHAR) AS value, "
        f"{share} AS percentage, {state} AS status"
    )


def warning(count: str, word: str = "WARNING") -> str:
    return f"CASE WHEN {count} > 0 THEN '{word}' ELSE 'PASS' END"


RECORDS = check("RECORD_COUNT", "total_rows", "count(*)", "'100%'", "'INFO'") + " FROM inc"
TWICE = "(SELECT count(*) FROM inc) - (SELECT count(*) FROM (SELECT DISTINCT * FROM inc))"
TOTALS = f"(SELECT count(*) AS n, {TWICE} AS d FROM inc)"
DUPLICATES = (
    check("DUPLICATE_CHECK", "duplicate_rows", "d", f"{percent('d', 'n')} || '%'", warning("d"))
    + f" FROM {TOTALS}"
)
NULLS = " UNION ALL ".join(
    check("NULL_CHECK", c, "k", f"{percent('k', 'n')} || '%'", warning("k"))
    + f" FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS k FROM inc)"
    for c in COLUMNS
)
AFFECTED = " + ".join(f"CAST(count(*) > count({c}) AS BIGINT)" for c in CRITICAL)
CRITICALS = (
    check("CRITICAL_NULL_CHECK", "critical_columns_with_nulls", "k", "k || '/4 columns affected'",
          warning("k", "FAIL"))
    + f" FROM (SELECT {AFFECTED} AS k FROM inc)"
)
REPORT_ROWS = f"{RECORDS} UNION ALL {DUPLICATES} UNION ALL {CRITICALS} UNION ALL {NULLS}"
REPORT = f"{WITH} {REPORT_ROWS}"
REJECTED = """(SELECT count(*) FROM (SELECT DISTINCT * FROM inc))
  - (SELECT count(*) FROM (SELECT DISTINCT User_ID, Opened FROM inc))"""
KEY_REJECTS = (
    check("DUPLICATE_KEY_CHECK", "rows_of_a_key_kept_elsewhere", "d", f"{percent('d', 'n')} || '%'", warning("d"))
    + f" FROM (SELECT count(*) AS n, {REJECTED} AS d FROM inc)"
)
AT = "TIMESTAMP '2024-01-15'"


def counted(kind: str, group: str, where: str = "true") -> str:
    return (
        f"SELECT '{kind}' AS aggregation_type, {group} AS group_column, 'incident_count' AS metric, "
        f"CAST(count(*) AS VARCHAR) AS value FROM silver WHERE {where} GROUP BY {group}"
    )


MONTH = "CAST(year(Opened) AS VARCHAR) || '-' || CAST(month(Opened) AS VARCHAR)"
GOLD = {
    "gold_by_priority": counted("by_priority", "Priority"),
    "gold_by_category": counted("by_category", "Category"),
    "gold_by_state": counted("by_state", "State"),
    "gold_by_month": counted("by_month", MONTH, "Opened IS NOT NULL"),
    "gold_avg_resolution": f"""SELECT 'avg_resolution_time' AS aggregation_type,
      Assignment_Group AS group_column, 'avg_resolution_hours' AS metric,
      CAST(round(avg({HOURS}), 2) AS VARCHAR) AS value
      FROM silver WHERE {HOURS} >= 0 GROUP BY Assignment_Group""",
}
def except_feed(version: int) -> str:
    """Changes of one version by EXCEPT ALL both ways."""
    new, old = (f"SELECT k, status, price FROM snap WHERE _version = {v}" for v in (version, version - 1))
    tail = f"""CAST({version} AS BIGINT) AS _commit_version,
      (SELECT min(_commit_timestamp) FROM snap WHERE _version = {version}) AS _commit_timestamp"""
    return (
        f"SELECT *, 'insert' AS _change_type, {tail} FROM ({new} EXCEPT ALL {old}) "
        f"UNION ALL SELECT *, 'delete' AS _change_type, {tail} FROM ({old} EXCEPT ALL {new})"
    )


def keyed_feed(version: int) -> str:
    """Changes of one version by a full outer join on the key."""
    pairs = f"""(SELECT n.k AS nk, n.status AS ns, n.price AS np, o.k AS ok, o.status AS os, o.price AS op
      FROM (SELECT * FROM snap WHERE _version = {version}) n
      FULL JOIN (SELECT * FROM snap WHERE _version = {version - 1}) o ON n.k = o.k)"""
    tail = f"""CAST({version} AS BIGINT) AS _commit_version,
      (SELECT min(_commit_timestamp) FROM snap WHERE _version = {version}) AS _commit_timestamp"""
    changed = "nk IS NOT NULL AND ok IS NOT NULL AND (ns IS DISTINCT FROM os OR np IS DISTINCT FROM op)"
    new, old = "nk AS k, ns AS status, np AS price", "ok AS k, os AS status, op AS price"
    return " UNION ALL ".join(
        f"SELECT {row}, '{kind}' AS _change_type, {tail} FROM {pairs} WHERE {where}"
        for row, kind, where in (
            (new, "insert", "ok IS NULL"),
            (old, "delete", "nk IS NULL"),
            (old, "update_preimage", changed),
            (new, "update_postimage", changed),
        )
    )


def rows_at(version: int) -> str:
    return f"{SNAP} SELECT k, status, price FROM snap WHERE _version = {version}"


COUNTS = {
    "null_counts": f"{WITH} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM inc"
        for c in COLUMNS
    ),
    "null_percentages": f"{WITH} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name,
          {percent(f"count(*) FILTER (WHERE {c} IS NULL)", "count(*)")} AS null_percentage FROM inc"""
        for c in COLUMNS
    ),
}


def oracle_sql() -> dict[str, str]:
    return {
        "csv_scan": f"{WITH} SELECT {TEXT_DATES} FROM inc",
        "csv_scan_typed": "SELECT * FROM orders",
        "csv_multi_line": "SELECT * FROM documents",
        "csv_malformed": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
            CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority
              WHEN o_orderstatus = 'P' THEN 'more' END AS o_orderpriority,
            CASE WHEN (o_orderstatus = 'P') <> (o_orderpriority = '5-LOW') THEN
              concat_ws(',', o_orderkey, o_orderstatus,
                CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END,
                CASE WHEN o_orderstatus = 'P' THEN 'more' END) END AS malformed_record
          FROM orders""",
        "csv_mixed_headers": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
          CASE WHEN o_totalprice >= 150000 THEN o_orderpriority END AS o_orderpriority FROM orders""",
        "table_detail": """SELECT 'before' AS state, CAST(16 AS BIGINT) AS numFiles, true AS has_bytes
          UNION ALL SELECT 'after', 1, true""",
        "silver_losses": f"""{SILVER} SELECT 'Opened' AS column_name,
            count(Opened) FILTER (WHERE State = 'F') AS lost_values FROM silver
          UNION ALL SELECT 'Updated', 0""",
        "gold_table": f"{SILVER} " + " UNION ALL ".join(GOLD.values()),
        "table_scan": f"{WITH} SELECT * FROM inc",
        "overwrite_roundtrip": f"{WITH} SELECT * FROM inc WHERE Updated IS NOT NULL",
        "append_rows": """SELECT * FROM orders
          UNION ALL SELECT * FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 5)""",
        "compact_roundtrip": f"{WITH} SELECT * FROM inc",
        "use_namespace": "SELECT * FROM orders",
        "set_table_property": "SELECT count(*) AS row_count, 'true' AS change_tracking FROM orders",
        "rename_columns": f"{WITH} SELECT * FROM inc",
        "sanitize_columns": f"{WITH} SELECT "
        + ", ".join(f"{c} AS {SPACED.get(c, c)}" for c in COLUMNS)
        + " FROM inc",
        "project": f"""{WITH} SELECT Number, Priority AS group_column, 'by_priority' AS kind FROM inc""",
        "cast_string": f"{WITH} SELECT Number, CAST({HOURS} AS VARCHAR) AS hours_text FROM inc",
        "table_profile": f"{WITH} SELECT count(*) AS row_count, CAST(16 AS INTEGER) AS column_count FROM inc",
        "ingest_metadata": """SELECT *, TIMESTAMP '2024-01-15' AS ingestion_timestamp,
          'orders.parquet' AS source_file_name FROM orders""",
        "bronze": f"""{WITH} SELECT {TEXT_DATES}, CAST(NULL AS VARCHAR) AS malformed_record,
          TIMESTAMP '2024-01-15' AS ingestion_timestamp, 'incidents.csv' AS source_file_name FROM inc""",
        "row_count": f"{WITH} SELECT count(*) AS row_count FROM inc",
        **COUNTS,
        "distinct_rows": f"{WITH} SELECT DISTINCT * FROM inc",
        "critical_null_rows": f"{WITH} SELECT * FROM inc WHERE {ANY_NULL}",
        "critical_clean_rows": f"{WITH} SELECT * FROM inc WHERE NOT ({ANY_NULL})",
        "nonneg_filter": f"{WITH} SELECT Number, {HOURS} AS hours FROM inc WHERE {HOURS} >= 0",
        "row_number_dups": f"{ROUTED} SELECT {C}, rn AS row_num FROM numbered",
        "duplicate_rows": f"{ROUTED} SELECT {C} FROM numbered WHERE rn > 1",
        "dedup_keep_first": f"{ROUTED} SELECT {C} FROM numbered WHERE rn = 1",
        "dedup_by_key": f"{BY_KEY} SELECT {C} FROM ranked WHERE rn = 1",
        "dedup_by_key_rejects": f"{BY_KEY} SELECT {C}, 'duplicate row' AS reject_reason FROM ranked WHERE rn > 1",
        "limit_n": f"""{WITH} SELECT * FROM inc WHERE Number IS NOT NULL
          ORDER BY Number NULLS FIRST, Opened NULLS FIRST, User_ID NULLS FIRST LIMIT 20""",
        "dq_record_count": f"{WITH} {RECORDS}",
        "dq_null_check": f"{WITH} {NULLS}",
        "dq_duplicate_check": f"{WITH} {DUPLICATES}",
        "dq_critical_check": f"{WITH} {CRITICALS}",
        "quality_report": f"{WITH} SELECT *, {AT} AS report_timestamp FROM ({REPORT_ROWS})",
        "quality_report_keyed": f"{WITH} {REPORT_ROWS} UNION ALL {KEY_REJECTS}",
        "quality_report_of_routed": REPORT,
        "dq_gate": f"""{WITH} SELECT CASE WHEN k = 0 THEN 'passed' ELSE 'quarantine' END AS decision,
          k AS critical_issues, d AS duplicate_rows
          FROM (SELECT {AFFECTED} AS k, any_value({TWICE}) AS d FROM inc)""",
        "reject_reason": f"{WITH} SELECT Number, {REASON} AS reject_reason FROM inc",
        "quarantine": f"""{ROUTED} SELECT *, {AT} AS quarantine_timestamp FROM routed
          WHERE reject_reason IS NOT NULL""",
        "quarantine_by_reason": f"""{ROUTED} SELECT reject_reason, count(*) AS row_count
          FROM routed WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
        "union_quarantine": f"{ROUTED} SELECT * FROM routed WHERE reject_reason IS NOT NULL",
        "fill_defaults": f"{WITH} SELECT {FILLED} FROM inc",
        "parse_timestamps": f"{WITH} SELECT * FROM inc",
        "parse_losses": f"""{WITH} SELECT 'Opened' AS column_name, CAST(0 AS BIGINT) AS lost_values
          UNION ALL SELECT 'Updated', 0 UNION ALL SELECT 'Priority', count(Priority) FROM inc""",
        "except_all": f"""{ROUTED} SELECT * FROM inc
          EXCEPT ALL SELECT {C} FROM routed WHERE reject_reason IS NULL""",
        "reconcile": f"""{ROUTED} SELECT count(*) AS source_rows,
          count(*) FILTER (WHERE reject_reason IS NULL) AS clean_rows,
          count(reject_reason) AS rejected_rows, true AS matched FROM routed""",
        "silver": f"{SILVER} SELECT * FROM silver",
        "count_by": """SELECT l_returnflag, count(*) AS incident_count FROM lineitem GROUP BY l_returnflag""",
        "avg_by": f"{WITH} SELECT Channel, round(avg({HOURS}), 2) AS avg_hours FROM inc GROUP BY Channel",
        "ordered_counts": f"""{WITH} SELECT *, CAST(row_number() OVER (
            ORDER BY incident_count DESC, Assignment_Group NULLS FIRST) AS INTEGER) AS position
          FROM (SELECT Assignment_Group, count(*) AS incident_count FROM inc GROUP BY Assignment_Group)""",
        "ordered_months": f"""{WITH} SELECT *, CAST(row_number() OVER (
            ORDER BY year_month NULLS FIRST) AS INTEGER) AS position
          FROM (SELECT strftime(Opened, '%Y-%m') AS year_month, count(*) AS incident_count FROM inc GROUP BY 1)""",
        "year_month_key": f"""{WITH} SELECT Number, {MONTH} AS year_month,
          strftime(Opened, '%Y-%m') AS padded FROM inc""",
        "duration_hours": f"{WITH} SELECT Number, {HOURS} AS resolution_time_hours FROM inc",
        **{name: f"{SILVER} {sql}" for name, sql in GOLD.items()},
        "gold_metrics": f"{SILVER} SELECT *, {AT} AS created_timestamp FROM ("
        + " UNION ALL ".join(GOLD.values())
        + ")",
        "layer_rows": f"""{SILVER},
          gold AS ({" UNION ALL ".join(GOLD.values())})
          SELECT 'bronze' AS layer, count(*) AS row_count FROM inc
          UNION ALL SELECT 'quality', 3 + 18
          UNION ALL SELECT 'silver', count(*) FROM silver
          UNION ALL SELECT 'quarantine', count(reject_reason) FROM routed
          UNION ALL SELECT 'gold', count(*) FROM gold""",
        "gold_of_orders": """WITH kept AS (
            SELECT CASE WHEN o_orderstatus = 'P' THEN 'Unknown' ELSE o_orderstatus END AS status,
              strftime(o_orderdate, '%Y-%m') AS month, CAST(o_custkey AS VARCHAR) AS customer
            FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED')
          SELECT 'by_status' AS aggregation_type, status AS group_column, 'order_count' AS metric,
            CAST(count(*) AS VARCHAR) AS value FROM kept GROUP BY status
          UNION ALL SELECT 'by_month', month, 'order_count', CAST(count(*) AS VARCHAR) FROM kept GROUP BY month
          UNION ALL SELECT 'by_customer', customer, 'order_count', CAST(count(*) AS VARCHAR) FROM kept
            GROUP BY customer""",
        "version_history": f"""{SNAP} SELECT _version AS version, min(_commit_timestamp) AS timestamp,
          count(*) AS row_count, CASE _version WHEN 0 THEN 'CREATE TABLE' WHEN 2 THEN 'MERGE' ELSE 'WRITE' END
          AS operation FROM snap GROUP BY _version""",
        "version_bounds": f"""{SNAP} SELECT min(_version) AS earliest_version,
          max(_version) AS latest_version FROM snap""",
        "as_of_version": rows_at(1),
        "as_of_timestamp": rows_at(2),
        "as_of_missing": f"""{SNAP} SELECT count(*) AS row_count, 0 AS version FROM snap WHERE _version = 0
          UNION ALL SELECT count(*), 9 FROM snap WHERE _version = 9""",
        "expired_versions": f"""{SNAP},
          held AS (SELECT _version, min(_commit_timestamp) AS ts, count(*) AS n FROM snap GROUP BY _version),
          next AS (SELECT *, lead(ts) OVER (ORDER BY _version) AS superseded FROM held)
          SELECT _version AS version, ts AS timestamp, n AS row_count FROM next
          WHERE superseded <= TIMESTAMP '2024-01-15' - INTERVAL 168 HOUR""",
        "retain_versions": f"""{SNAP} SELECT * FROM snap WHERE _version NOT IN (
          SELECT DISTINCT a._version FROM snap a JOIN (SELECT DISTINCT _version, _commit_timestamp FROM snap) b
          ON b._version = a._version + 1
          WHERE b._commit_timestamp <= TIMESTAMP '2024-01-15' - INTERVAL 168 HOUR)""",
        "change_feed": f"{SNAP} " + " UNION ALL ".join(map(except_feed, (1, 2, 3))),
        "change_feed_from_nothing": f"{SNAP} " + " UNION ALL ".join(map(except_feed, (0, 1))),
        "change_feed_keyed": f"{SNAP} " + " UNION ALL ".join(map(keyed_feed, (0, 1, 2))),
        "change_summary": f"""{SNAP}, feed AS ({except_feed(2)} UNION ALL {except_feed(3)})
          SELECT _change_type, count(*) AS count FROM feed GROUP BY _change_type""",
        "stored_as_of": rows_at(2),
        "appended_changes": """SELECT *, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version
          FROM orders ORDER BY o_orderkey LIMIT 5""",
        "stored_retention": f"""{SNAP} SELECT _version AS version, min(_commit_timestamp) AS timestamp,
          count(*) AS row_count FROM snap GROUP BY _version
          HAVING _version >= (SELECT max(_version) FROM snap
            WHERE _commit_timestamp <= TIMESTAMP '2024-01-15' - INTERVAL 168 HOUR)""",
        "stored_change_feed": f"{SNAP} " + " UNION ALL ".join(map(except_feed, (2, 3))),
        "table_versions": """SELECT CAST(0 AS INTEGER) AS version, count(*) AS row_count,
            'CREATE TABLE' AS operation FROM orders
          UNION ALL SELECT 1, count(*), 'WRITE' FROM orders WHERE o_orderstatus <> 'P'
          UNION ALL SELECT 2, count(*), 'OPTIMIZE' FROM orders WHERE o_orderstatus <> 'P'""",
    }
