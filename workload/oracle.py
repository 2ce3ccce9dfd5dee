"""The sample queries as SQL for a second engine, on the same tables."""

from __future__ import annotations

from workload.tables import BALANCES, DAY, FIRST_DAY, LAST_DAY, RUN_TS, STATUS_EVENTS, SUMMARY, TRANSACTIONS

D, LAST = f"DATE '{DAY}'", f"DATE '{LAST_DAY}'"
VBA = "account_type IN ('VBA')"
VBA_TA = "account_type IN ('VBA', 'TA')"
NOT_VBO = "account_type NOT IN ('VBO')"


def blank(*fields: str) -> str:
    tests = [
        f"({f} IS NULL OR CAST({f} AS VARCHAR) IN ('', 'null', 'NULL') "
        f"OR length(trim(CAST({f} AS VARCHAR), ' ')) = 0)"
        for f in fields
    ]
    return "(" + " OR ".join(tests) + ")"


def error_row(table: str, kind: str, count: str, detail: str) -> str:
    return (
        f"'lake' AS source_type, {kind} AS error_type, {count} AS null_count, "
        f"{detail} AS error_detail, '{RUN_TS}' AS lst_updt_ts, "
        f"CAST(as_of_date AS VARCHAR) AS as_of_date, '{table}' AS tbl_nm"
    )


def nulls(table: str, fields: tuple[str, ...], scope: str = "TRUE", where: str = "TRUE") -> str:
    count = f"count(*) FILTER (WHERE {scope} AND {blank(*fields)})"
    row = error_row(table, "'NULL_VALUES'", count, f"'{','.join(fields)}'")
    return f"SELECT {row} FROM {table} WHERE {where} GROUP BY as_of_date"


def duplicates(table: str, keys: tuple[str, ...], scope: str = "TRUE") -> str:
    detail = "concat_ws(',', " + ", ".join(keys) + ")"
    row = error_row(table, f"'DUP_ERROR:{','.join(keys)}'", "count(*)", detail)
    grouped = ", ".join(keys)
    return (
        f"SELECT {row} FROM {table} WHERE {scope} GROUP BY as_of_date, {grouped} "
        f"HAVING count(*) > 1"
    )


def union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def with_(tables: str, query: str) -> str:
    return f"WITH {tables}\n{query}"


BOTH = f"{BALANCES}, {TRANSACTIONS}"
QUALITY = union(
    nulls("balances", ("dirty",), NOT_VBO),
    nulls("balances", ("dirty", "account_type", "amount"), VBA_TA),
    nulls("balances", ("amount",), VBA),
    duplicates("balances", ("account_id",), VBA_TA),
    nulls("transactions", ("account_id", "flag")),
    duplicates("transactions", ("supplier_id",)),
)

DOCUMENTS = f"docs AS (SELECT *, {D} AS as_of_date FROM documents)"

# Rows of a date produced (n) and stored (m): one table was not asked for its first date and
# misses its last.
COUNTS = f"""
found AS (
  SELECT 'lake' AS dest_db, 'balances' AS dest_tbl, as_of_date, count(*) AS n FROM balances GROUP BY ALL
  UNION ALL SELECT 'vault', 'balances', as_of_date, count(*) FROM balances
    WHERE account_type = 'VBA' GROUP BY ALL
  UNION ALL SELECT 'lake', 'transactions', as_of_date, count(*) FROM transactions GROUP BY ALL),
counts AS (
  SELECT dest_db, dest_tbl, as_of_date,
    CASE WHEN dest_db || dest_tbl = 'lakebalances' AND as_of_date = DATE '{FIRST_DAY}' THEN 0 ELSE n END AS n,
    CASE WHEN dest_db || dest_tbl = 'lakebalances' AND as_of_date = {LAST} THEN 0 ELSE n END AS m
  FROM found)"""


def metric_row() -> str:
    zeros = ", ".join(
        f"CAST(0 AS BIGINT) AS {name}" for name in
        ("src_add", "src_edit", "src_delete", "dest_edit", "dest_delete", "dest_edit_add",
         "dest_delete_add", "dest_add_change")
    )
    return (
        f"'upstream' AS src_db, dest_tbl || '_feed' AS src_tbl, CAST(n AS BIGINT) AS src_count, dest_db, "
        f"CAST(m AS BIGINT) AS dest_count, CAST(m AS BIGINT) AS dest_add, {zeros}, '{RUN_TS}' AS lst_updt_ts, "
        f"CAST(as_of_date AS VARCHAR) AS as_of_date, dest_tbl"
    )


PREVIOUS = """
SELECT dest_db, dest_tbl, as_of_date,
  lag(as_of_date) OVER (PARTITION BY dest_db, dest_tbl ORDER BY as_of_date) AS yest_ingest_dt
FROM counts"""

REPORT = f"""
SELECT {metric_row()}, CAST(0 AS INTEGER) AS yest_count, CAST(m AS BIGINT) AS today_total,
  CAST(m AS BIGINT) AS today_count,
  coalesce(CAST(yest_ingest_dt AS VARCHAR), 'NULL') AS yest_ingest_dt
FROM (SELECT c.*, p.yest_ingest_dt FROM counts c
      JOIN ({PREVIOUS}) p ON p.dest_db = c.dest_db AND p.dest_tbl = c.dest_tbl AND p.as_of_date = c.as_of_date)"""

REPORT_ORDER = (
    "as_of_date", "src_db", "src_tbl", "src_count", "src_add", "src_edit", "src_delete",
    "dest_db", "dest_tbl", "dest_count", "dest_add", "dest_edit", "dest_delete",
    "dest_edit_add", "dest_delete_add", "dest_add_change", "lst_updt_ts", "yest_count",
    "today_total", "yest_ingest_dt", "today_count",
)

JUDGED = f"""{STATUS_EVENTS}, {SUMMARY},
judged AS (
  SELECT *, coalesce(CAST(last_success AS DATE) = DATE '{LAST_DAY}', FALSE)
    OR coalesce(CAST(last_no_change AS DATE) = DATE '{LAST_DAY}', FALSE) AS is_fresh
  FROM summary)"""


def verdicts(label: str, late: str, source: str = "judged") -> str:
    return f"""SELECT domain, count(*) AS n_tables, count(*) FILTER (WHERE NOT is_fresh) AS n_stale,
      CASE WHEN {late} THEN 'FAILED' WHEN count(*) FILTER (WHERE NOT is_fresh) > 0 THEN 'WAIT'
           ELSE 'READY' END AS verdict, {label} AS now_utc
    FROM {source} GROUP BY domain"""


def late(moment: str) -> str:
    local = f"(TIMESTAMP '{moment}' AT TIME ZONE 'UTC') AT TIME ZONE 'EST5EDT'"
    return f"strftime({local}, '%H:%M:%S') >= '11:59:00'"


MOMENTS = (
    "2024-01-30 16:58:59", "2024-01-30 16:59:00", "2024-07-30 15:58:59", "2024-07-30 15:59:00",
)


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def iso(column: str) -> str:
    return f"coalesce(strftime({column}, '%Y-%m-%dT%H:%M:%S.%f'), 'NA')"


LOG = """log AS (
          SELECT CASE event_type WHEN 'error' THEN 'Error' WHEN 'click' THEN 'WARN'
              WHEN 'view' THEN 'NOTE' WHEN 'purchase' THEN 'ERROR' ELSE 'info' END
            || ': event ' || CAST(event_id AS VARCHAR) || ' ' || props
            || CASE WHEN event_id % 7 = 0 THEN ' Exception' ELSE '' END AS value
          FROM events)"""


def log_lines(head: str) -> str:
    return union(*[
        f"SELECT '{head}{level}|' || value AS value FROM log WHERE contains(value, '{text}')"
        for text, level in
        (("Error", "ERROR"), ("WARN", "WARN"), ("NOTE", "NOTE"), ("Exception", "Exception"))
    ])


def error_line(code: str) -> str:
    return (
        f"concat_ws('|', as_of_date, 'INFO', '{code}', source_type, tbl_nm, error_type, "
        f"CAST(null_count AS VARCHAR), error_detail, lst_updt_ts) AS value"
    )


def ingested(*databases: str) -> str:
    parts = []
    for day in (DAY, LAST_DAY):
        on = f"DATE '{day}'"
        parts += [
            f"""SELECT '{database}' AS dest_db, 'positions' AS dest_tbl, {on} AS as_of_date,
              count(*) AS n, count(*) AS m FROM (
              SELECT DISTINCT account_id, account_type FROM balances WHERE as_of_date <= {on})"""
            for database in databases
        ]
        parts.append(f"""SELECT 'lake', 'shipments', {on}, count(*), count(*) FROM lineitem
            WHERE l_shipdate < CAST({on} AS TIMESTAMP) + INTERVAL 33 HOURS - INTERVAL 28 YEARS
              AND l_shipdate >= CAST({on} AS TIMESTAMP) - INTERVAL 1 DAY - INTERVAL 29 YEARS""")
    return f"SELECT {metric_row()}, ' ' AS error_msg FROM ({union(*parts)})"


ORACLE = {
    "null_check": with_(BALANCES, nulls("balances", ("dirty",))),
    "null_check_scope_vba": with_(BALANCES, nulls("balances", ("dirty",), VBA)),
    "null_check_scope_vba_ta": with_(BALANCES, nulls("balances", ("dirty",), VBA_TA)),
    "null_check_scope_not_vbo": with_(BALANCES, nulls("balances", ("dirty",), NOT_VBO)),
    "null_check_numeric": with_(BALANCES, nulls("balances", ("amount",))),
    "null_check_kept": with_(BALANCES, union(
        nulls("balances", ("dirty",)), nulls("balances", ("dirty", "amount"), VBA))),
    "null_check_multi": with_(BALANCES, nulls("balances", ("dirty", "account_type"))),
    "null_check_transactions": with_(TRANSACTIONS, union(
        nulls("transactions", ("flag",), NOT_VBO),
        nulls("transactions", ("flag", "amount", "account_type"), VBA_TA),
        nulls("transactions", ("amount",), VBA),
        nulls("transactions", ("flag", "amount")),
    )),
    "null_check_overrides": with_(BALANCES, union(
        nulls("balances", ("dirty",), VBA), nulls("balances", ("dirty",), NOT_VBO),
        duplicates("balances", ("account_id",), VBA_TA),
    )),
    "null_check_day": with_(BALANCES, union(*[
        nulls("balances", ("dirty",), scope, f"as_of_date = {D}")
        for scope in ("TRUE", VBA, VBA_TA, NOT_VBO)
    ])),
    "duplicate_check": with_(BALANCES, duplicates("balances", ("account_id",))),
    "duplicate_check_scope": with_(BALANCES, duplicates("balances", ("account_id",), VBA_TA)),
    "duplicate_check_multi_key": with_(
        BALANCES, duplicates("balances", ("account_id", "account_type"))
    ),
    "duplicate_check_transactions": with_(TRANSACTIONS, union(
        duplicates("transactions", ("supplier_id", "flag")),
        duplicates("transactions", ("supplier_id", "flag"), VBA_TA),
        duplicates("transactions", ("part_id",)),
    )),
    "duplicate_check_texts": with_(
        DOCUMENTS, duplicates("docs", ("text",)).replace("'docs' AS tbl_nm", "'documents' AS tbl_nm")
    ),
    "duplicate_check_normalised": with_(
        f"customers AS (SELECT c_mktsegment AS segment, {D} AS as_of_date FROM customer)",
        duplicates("customers", ("segment",)),
    ),
    "quality_run": with_(BOTH, QUALITY),
    "quality_write": with_(BALANCES, union(
        nulls("balances", ("dirty",), NOT_VBO),
        nulls("balances", ("dirty", "account_type", "amount"), VBA_TA),
        nulls("balances", ("amount",), VBA),
        duplicates("balances", ("account_id",), VBA_TA),
    )),
    "quality_check": with_(
        f"customers AS (SELECT c_mktsegment, {D} AS as_of_date FROM customer)",
        duplicates("customers", ("c_mktsegment",)),
    ),
    "ingestion_mapping": """
        SELECT lower(c_name) AS source_table, upper(c_name) AS target_table,
          'folder_' || CAST(c_nationkey AS VARCHAR) AS target_folder,
          'upstream' AS source_database, 'lake' AS target_database,
          c_mktsegment AS domain_name
        FROM customer
        JOIN (SELECT 'all' AS pick UNION ALL SELECT 'one')
          ON pick = 'all' OR (c_mktsegment = 'HOUSEHOLD' AND lower(c_name) = 'customer#000000000')""",
    "rule_mapping": """
        SELECT 'table_' || CAST(p_partkey AS VARCHAR) AS target_table,
          CASE WHEN p_size % 2 = 0 THEN p_brand || '+' || p_name ELSE 'None' END AS null_check,
          CAST(CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_fields,
          CASE WHEN p_size % 3 = 0 THEN 'None' ELSE 'p_name,p_brand' END AS dup_check,
          p_type AS domain,
          CASE WHEN p_size % 5 = 0 THEN 'ConditionalNulls+ConditionalDupNonLegacy'
               ELSE 'None' END AS dq_overrides
        FROM part""",
    "metric_mapping": """
        SELECT 'src_' || CAST(o_orderkey AS VARCHAR) AS source_table,
          'Tgt_' || CAST(o_custkey AS VARCHAR) AS target_table,
          'upstream' AS source_database, 'lake' AS target_database,
          o_orderstatus AS target_folder, o_orderpriority AS batch_type
        FROM orders
        JOIN (SELECT 'all' AS pick UNION ALL SELECT 'one')
          ON pick = 'all' OR (o_orderpriority = '5-LOW' AND o_orderkey = 0)""",
    "snapshot_replace": with_(BALANCES, f"""
        SELECT CAST(as_of_date AS VARCHAR) AS as_of_date, count(*) AS dest_count,
          CAST(sum(event_id) AS BIGINT) AS sum_ids, count(dirty) AS n_dirty
        FROM balances
        WHERE CASE WHEN as_of_date = {D} THEN coalesce(account_type = 'VBA', FALSE)
                   ELSE as_of_date <> {D} - INTERVAL 1 DAY END
        GROUP BY as_of_date"""),
    "snapshot_scan": with_(BALANCES, f"""
        SELECT event_id, account_id, account_type, dirty, amount,
          CAST(as_of_date AS VARCHAR) AS as_of_date
        FROM balances JOIN (SELECT 'all' AS pick UNION ALL SELECT 'one')
          ON pick = 'all' OR as_of_date = {D}"""),
    "catalog_partitions": with_(BALANCES, """
        SELECT 'lake' AS dest_db, 'balances' AS dest_tbl, CAST(as_of_date AS VARCHAR) AS as_of_date,
          count(*) AS dest_count
        FROM balances GROUP BY as_of_date"""),
    "catalog_sync": with_(BALANCES, """
        SELECT 'lake' AS dest_db, 'balances' AS dest_tbl, CAST(as_of_date AS VARCHAR) AS as_of_date,
          count(*) AS dest_count, CAST(count(*) OVER () AS INT) AS added, 1 AS dropped, count(*) OVER () AS known
        FROM balances GROUP BY as_of_date"""),
    "stored_query": with_(BALANCES, f"""
        SELECT account_id, account_type, count(*) AS n_rows, count(dirty) AS n_dirty
        FROM balances WHERE as_of_date <= {D} GROUP BY account_id, account_type"""),
    "ingest_domain": with_(BALANCES, ingested("lake", "vault")),
    "ingest_failing": with_(BALANCES, ingested("lake")),
    "transform_counts": with_(
        f"{BOTH}, {COUNTS}", f"SELECT {metric_row()}, ' ' AS error_msg FROM counts"
    ),
    "previous_snapshot": with_(BALANCES, union(*[
        f"SELECT '{day}' AS as_of_date, CAST(max(as_of_date) AS VARCHAR) AS yest_ingest_dt "
        f"FROM balances WHERE as_of_date < DATE '{day}'"
        for day in (DAY, "2024-01-01")
    ])),
    "previous_snapshot_history": with_(f"{BOTH}, {COUNTS}", f"""
        SELECT dest_db, dest_tbl, CAST(as_of_date AS VARCHAR) AS as_of_date,
          CAST(yest_ingest_dt AS VARCHAR) AS yest_ingest_dt FROM ({PREVIOUS})"""),
    "previous_dates": with_(f"{BOTH}, {COUNTS}", f"""
        SELECT dest_db, dest_tbl, CAST(max(as_of_date) FILTER (as_of_date < {D}) AS VARCHAR) AS yest_ingest_dt
        FROM found GROUP BY dest_db, dest_tbl"""),
    "previous_dates_listed": with_(f"{BOTH}, {COUNTS}", f"""
        SELECT dest_db, dest_tbl, CAST(max(as_of_date) FILTER (as_of_date < {D} AND NOT (
          as_of_date = DATE '2024-01-14' AND (dest_db, dest_tbl) = (SELECT min((dest_db, dest_tbl)) FROM found))
        ) AS VARCHAR) AS yest_ingest_dt
        FROM found GROUP BY dest_db, dest_tbl"""),
    "reconcile_rows": with_(BALANCES, f"""
        SELECT CAST(as_of_date AS VARCHAR) AS as_of_date, count(*) AS src_count, count(*) AS dest_count,
          CASE WHEN as_of_date = {D} THEN 'stored rows differ from the rows produced' ELSE ' ' END AS error_msg
        FROM balances GROUP BY ALL"""),
    "run_dates": with_(TRANSACTIONS, f"""
        SELECT DISTINCT CAST(as_of_date AS VARCHAR) AS as_of_date,
          {stamp("CAST(as_of_date AS TIMESTAMP) + INTERVAL 33 HOURS")} AS next_ingest_date,
          strftime(CAST(as_of_date AS TIMESTAMP) - INTERVAL 1 DAY, '%Y-%m-%d') AS prev_ingest_date
        FROM transactions"""),
    "metrics_export": with_(f"{BOTH}, {COUNTS}", REPORT),
    "metrics_report": with_(f"{BOTH}, {COUNTS}", f"""
        SELECT concat_ws('|', {", ".join(REPORT_ORDER)}) AS value FROM ({REPORT})
        WHERE as_of_date = '{DAY}'"""),
    "expand_tables": """
        SELECT r_name AS domain, 'P' || CAST(n_nationkey AS VARCHAR) AS app_prefix,
          r_name || '_Ingestion' AS pipeline, n_name AS db, c_name AS "table"
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        JOIN (SELECT 'all' AS pick UNION ALL SELECT 'one') ON pick = 'all' OR r_name = 'ASIA'""",
    "poll_defaults": """
        SELECT 'poll' AS action, 'status' AS "messageType", r_name AS pipeline FROM region""",
    "status_summary": with_(f"{STATUS_EVENTS}, {SUMMARY}", f"""
        SELECT domain, table_name, {stamp("last_updated")} AS "lastUpdated",
          latest_status AS "latestStatus", {stamp("last_success")} AS "lastSuccess",
          {stamp("last_no_change")} AS "lastNoChange", {stamp("last_failure")} AS "lastFailure",
          {stamp("last_maintenance")} AS "lastMaintenance"
        FROM summary"""),
    "freshness": with_(JUDGED, "SELECT domain, table_name, is_fresh FROM judged"),
    "readiness": with_(
        f"{JUDGED}, fresh AS (SELECT * FROM judged WHERE is_fresh)",
        union(
            *[verdicts(f"'{moment}'", late(moment)) for moment in MOMENTS],
            verdicts("'fresh only'", late(MOMENTS[0]), "fresh"),
        ),
    ),
    "poll_response": with_(JUDGED, """
        SELECT 'all' AS domain, table_name, latest_status AS "latestStatus", is_fresh
        FROM judged"""),
    "status_publish": with_(JUDGED, f"""
        SELECT '{LAST_DAY}' AS as_of_date, domain AS dest_tbl, table_name,
          latest_status AS "latestStatus", {iso("last_success")} AS "lastSuccess",
          {iso("last_no_change")} AS "lastNoChange"
        FROM judged WHERE is_fresh"""),
    "ready_list": with_(JUDGED, """
        SELECT CASE WHEN is_fresh THEN 'ready' ELSE 'failed' END AS list, domain,
          table_name, latest_status AS "latestStatus"
        FROM judged"""),
    "readiness_watch": with_(JUDGED, """
        SELECT 'all' AS domain, table_name, latest_status AS "latestStatus"
        FROM judged WHERE NOT is_fresh"""),
    "readiness_deadline": with_(JUDGED, """
        SELECT 'FAILED' AS verdict, table_name, latest_status AS "latestStatus"
        FROM judged WHERE NOT is_fresh"""),
    "error_export": with_(BOTH, f"SELECT {error_line('2003')} FROM ({QUALITY})"),
    "error_export_tabs": with_(
        f"""customers AS (SELECT c_mktsegment || '|' || CAST(c_nationkey AS VARCHAR) AS label,
            {D} AS as_of_date FROM customer)""",
        f"SELECT {error_line('2003')} FROM ({duplicates('customers', ('label',))})",
    ),
    "error_export_file": with_(BALANCES, f"""
        SELECT {error_line('2417')} FROM ({union(
            nulls("balances", ("amount", "dirty"), NOT_VBO),
            duplicates("balances", ("account_type", "account_id"), VBA_TA),
        )})"""),
    "log_classify": f"""
        WITH {LOG}
        {union(log_lines(f"{DAY}|INFO|99|account|account_data_ingestion|"),
               log_lines(f"{DAY}|INFO|99|ACCOUNT|account_dq_check|"))}""",
    "log_stream": f"""
        WITH {LOG}
        {log_lines(f"{DAY}|INFO|99|account|account_data_ingestion|")}""",
}
