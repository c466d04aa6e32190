"""The driver queries in plain SQL, written independently of the DataFrame plans."""

from __future__ import annotations

# Inputs derived from the test tables, as common table expressions.
_VIEWS = {
    "users_raw": """
SELECT CAST(c_custkey AS VARCHAR) AS id, '  ' || lower(c_mktsegment) AS firstName,
       lower(c_name) || '  ' AS lastName,
       ' ' || lower(replace(c_name, '#', '.')) || '@corp.example ' AS email,
       TIMESTAMP '2024-01-01 00:00:00' AS etl_time
FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), lower(c_mktsegment), 'renamed ' || lower(c_name),
       lower(replace(c_name, '#', '.')) || '@corp.example', TIMESTAMP '2024-02-01 00:00:00'
FROM customer WHERE c_custkey % 3 = 0
UNION ALL
SELECT CAST(NULL AS VARCHAR), 'ghost', 'ghost', 'ghost@corp.example', TIMESTAMP '2024-02-02 00:00:00'
FROM customer WHERE c_custkey % 5 = 0""",
    "users_std": """
SELECT id, firstName, lastName, email, etl_time FROM (
  SELECT id, upper(trim(firstName)) AS firstName, upper(trim(lastName)) AS lastName,
         trim(email) AS email, etl_time,
         row_number() OVER (PARTITION BY id ORDER BY etl_time DESC) AS rn
  FROM users_raw WHERE id IS NOT NULL) WHERE rn = 1""",
    "hours_raw": """
SELECT CAST(user_id AS VARCHAR) AS userId,
       CASE event_type WHEN 'error' THEN '-1.00' WHEN 'signup' THEN 'n/a'
            ELSE CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) END AS total_billable_hours,
       CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS start_date,
       CAST(CAST(date_trunc('week', ts) + INTERVAL '6' DAY AS DATE) AS VARCHAR) AS end_date,
       ts AS etl_time
FROM events""",
    "hours_valid": """
SELECT userId, TRY_CAST(total_billable_hours AS DOUBLE) AS total_billable_hours,
       CAST(start_date AS DATE) AS start_date, CAST(end_date AS DATE) AS end_date, etl_time
FROM hours_raw
WHERE userId IS NOT NULL AND TRY_CAST(total_billable_hours AS DOUBLE) >= 0""",
    "hours_std": """
SELECT userId, total_billable_hours, start_date, end_date, etl_time FROM (
  SELECT *, row_number() OVER (PARTITION BY userId, start_date, end_date
                               ORDER BY etl_time DESC, total_billable_hours DESC) AS rn
  FROM hours_valid) WHERE rn = 1""",
    "merge_base": """
SELECT userId, total_billable_hours, start_date, end_date, etl_time FROM (
  SELECT *, row_number() OVER (PARTITION BY userId, start_date, end_date
                               ORDER BY etl_time DESC, total_billable_hours DESC) AS rn
  FROM hours_valid WHERE etl_time < TIMESTAMP '2024-01-16 00:00:00') WHERE rn = 1""",
    "merge_updates": """
SELECT userId, total_billable_hours, start_date, end_date, etl_time FROM (
  SELECT *, row_number() OVER (PARTITION BY userId, start_date, end_date
                               ORDER BY etl_time DESC, total_billable_hours DESC) AS rn
  FROM (SELECT userId, total_billable_hours, start_date, end_date,
               CASE WHEN CAST(userId AS BIGINT) % 2 = 0 THEN etl_time - INTERVAL '10' DAY
                    ELSE etl_time END AS etl_time
        FROM hours_valid WHERE etl_time >= TIMESTAMP '2024-01-10 00:00:00')) WHERE rn = 1""",
    "undated_base": """
SELECT * REPLACE (CASE WHEN CAST(userId AS BIGINT) % 4 <> 0 THEN end_date END AS end_date) FROM merge_base""",
    "undated_updates": """
SELECT * REPLACE (CASE WHEN CAST(userId AS BIGINT) % 4 <> 0 THEN end_date END AS end_date) FROM merge_updates""",
    "project_tasks": """
SELECT p_partkey AS id, p_partkey % 500 AS projectId,
       CASE p_size % 8 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE 1 END AS isNonBillable
FROM part""",
    "billable_projects": """
SELECT DISTINCT projectId FROM project_tasks
WHERE coalesce(isNonBillable, 0) = 0 AND projectId <> 0""",
    "time_entries": """
SELECT o_custkey AS userId, l_partkey % 500 AS projectId, CAST(l_shipdate AS DATE) AS entry_date,
       CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS decimalHours
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "billable_entries": """
SELECT userId, projectId, entry_date, decimalHours FROM time_entries
WHERE projectId IN (SELECT projectId FROM billable_projects)""",
    "billable_year": """
SELECT userId, SUM(coalesce(decimalHours, 0.0)) AS total_billable_hours FROM billable_entries
WHERE entry_date >= DATE '1997-01-01' AND entry_date <= DATE '1997-12-31'
GROUP BY userId""",
    "mapping": """
SELECT replace(c_name, '#', '.') || '@Corp.Example' AS email, o_orderpriority AS issuer_company,
       o_orderdate AS updated_at, o_orderkey AS seq
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "latest_issuer": """
SELECT email_key, issuer_company FROM (
  SELECT lower(email) AS email_key, issuer_company,
         row_number() OVER (PARTITION BY lower(email)
                            ORDER BY updated_at DESC, seq DESC, issuer_company DESC) AS rn
  FROM mapping) WHERE rn = 1""",
    "month_to_date": """
SELECT o.o_orderkey AS invoice_id, SUM(coalesce(e.decimalHours, 0.0)) AS hours
FROM orders o JOIN billable_entries e
  ON e.userId = o.o_custkey
 AND e.entry_date >= CAST(date_trunc('month', o.o_orderdate) AS DATE)
 AND e.entry_date <= CAST(o.o_orderdate AS DATE)
GROUP BY o.o_orderkey""",
    "invoices": """
SELECT o_orderkey AS invoice_id, o_custkey AS userId,
       replace(c_name, '#', '.') || '@corp.example' AS email,
       CASE WHEN o_orderkey % 7 = 0 THEN 'Wrong Co' ELSE ' ' || upper(o_orderpriority) || ' ' END AS razon_social,
       CASE WHEN o_orderkey % 11 = 0 THEN '000000000000' ELSE '999999999999' END AS rut_receptor,
       CASE WHEN o_orderkey % 13 = 0 THEN 'consulting'
            ELSE 'Platform Engineering reviewed under Clause 7 of the frame contract' END AS description,
       CAST(o_orderdate AS DATE) AS invoice_date,
       coalesce(m.hours, 8.0) + CASE o_orderkey % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 0.005 ELSE 1.0 END AS amount_of_hours,
       m.hours AS timesheet_hours,
       CAST(100 AS DOUBLE) AS rate
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN month_to_date m ON m.invoice_id = o_orderkey""",
    "decisions": """
SELECT i.invoice_id, i.userId, i.email, i.razon_social, i.amount_of_hours, i.rate, i.description, i.invoice_date,
       concat_ws(',',
         CASE WHEN i.invoice_id % 31 = 0 OR u.id IS NULL THEN 'unknown_user' END,
         CASE WHEN i.invoice_id % 31 = 0 OR l.issuer_company IS NULL THEN 'no_mapping' END,
         CASE WHEN damaged THEN 'parse_error' END,
         CASE WHEN NOT damaged AND i.invoice_id % 31 <> 0
               AND lower(trim(i.razon_social)) <> lower(l.issuer_company) THEN 'issuer_mismatch' END,
         CASE WHEN NOT damaged AND i.rut_receptor <> '999999999999' THEN 'receiver_mismatch' END,
         CASE WHEN NOT damaged AND i.invoice_id % 13 = 0 THEN 'missing_keywords' END,
         CASE WHEN NOT damaged AND i.invoice_id % 29 = 0 THEN 'bad_date' END,
         CASE WHEN NOT damaged AND i.invoice_id % 29 <> 0 AND i.invoice_id % 31 <> 0 AND u.id IS NOT NULL
               AND i.timesheet_hours IS NULL THEN 'no_hours' END,
         CASE WHEN NOT damaged AND i.invoice_id % 29 <> 0 AND i.invoice_id % 31 <> 0 AND u.id IS NOT NULL
               AND i.timesheet_hours IS NOT NULL
               AND NOT abs(i.amount_of_hours - i.timesheet_hours) < 0.01 THEN 'hours_mismatch' END
       ) AS failures
FROM (SELECT *, (invoice_id % 17 = 0 OR invoice_id % 19 = 0 OR invoice_id % 23 = 0) AS damaged FROM invoices) i
LEFT JOIN users_std u ON lower(u.email) = lower(i.email)
LEFT JOIN latest_issuer l ON l.email_key = lower(i.email) AND NOT contains(l.email_key, '3@')""",
}

# The mapping history as saved: without the sequence number that breaks ties.
_VIEWS["latest_saved_issuer"] = _VIEWS["latest_issuer"].replace("seq DESC, ", "")
_VIEWS["saved_decisions"] = _VIEWS["decisions"].replace("latest_issuer", "latest_saved_issuer")

# View -> views it reads.
_READS = {
    "users_std": ["users_raw"],
    "hours_valid": ["hours_raw"],
    "hours_std": ["hours_valid"],
    "merge_base": ["hours_valid"],
    "merge_updates": ["hours_valid"],
    "undated_base": ["merge_base"],
    "undated_updates": ["merge_updates"],
    "billable_projects": ["project_tasks"],
    "billable_entries": ["time_entries", "billable_projects"],
    "billable_year": ["billable_entries"],
    "latest_issuer": ["mapping"],
    "month_to_date": ["billable_entries"],
    "invoices": ["month_to_date"],
    "decisions": ["invoices", "users_std", "latest_issuer"],
    "latest_saved_issuer": ["mapping"],
    "saved_decisions": ["invoices", "users_std", "latest_saved_issuer"],
}


def _with(views: list[str], body: str) -> str:
    ordered: list[str] = []

    def visit(view: str) -> None:
        for read in _READS.get(view, []):
            visit(read)
        if view not in ordered:
            ordered.append(view)

    for view in views:
        visit(view)
    parts = ",\n".join(f"{view} AS ({_VIEWS[view].strip()})" for view in ordered)
    return f"WITH {parts}\n{body.strip()}" if parts else body.strip()


_USERS_COLUMNS = "id, firstName, lastName, email, etl_time"
_HOURS_COLUMNS = "userId, total_billable_hours, start_date, end_date, etl_time"

_MERGED = """
SELECT coalesce(b.userId, u.userId) AS userId,
       CASE WHEN b.userId IS NULL OR u.etl_time > b.etl_time THEN u.total_billable_hours
            ELSE b.total_billable_hours END AS total_billable_hours,
       coalesce(b.start_date, u.start_date) AS start_date,
       coalesce(b.end_date, u.end_date) AS end_date,
       CASE WHEN b.userId IS NULL OR u.etl_time > b.etl_time THEN u.etl_time
            ELSE b.etl_time END AS etl_time
FROM merge_base b FULL OUTER JOIN merge_updates u
  ON b.userId = u.userId AND b.start_date = u.start_date AND b.end_date = u.end_date"""
_MERGE = _with(["merge_base", "merge_updates"], _MERGED)
_UNDATED = _MERGED.replace("merge_", "undated_")
_MERGE_NULLS = _with(
    ["undated_base", "undated_updates"],
    f"""
SELECT *, FALSE AS null_safe FROM ({_UNDATED})
UNION ALL
SELECT *, TRUE FROM ({_UNDATED.replace("b.end_date = u", "b.end_date IS NOT DISTINCT FROM u")})""",
)

_COUNTS = """
SELECT 1 AS pos, 'users' AS label,
       (SELECT COUNT(DISTINCT id) FROM users_raw) AS raw_count,
       (SELECT COUNT(DISTINCT id) FROM users_std) AS std_count
UNION ALL
SELECT 2, 'billable_hours_summary',
       (SELECT COUNT(DISTINCT userId) FROM hours_raw), (SELECT COUNT(DISTINCT userId) FROM hours_std)
UNION ALL
SELECT 3, 'hours_full_key',
       (SELECT COUNT(DISTINCT (userId, start_date, end_date)) FROM hours_raw),
       (SELECT COUNT(DISTINCT (userId, start_date, end_date)) FROM hours_std)"""
_LAYERS = ["users_std", "hours_std"]

_STORE = """
SELECT email, razon_social, ruc_emisor, amount_of_hours, rate, description, year, month FROM (
  SELECT lower(email) AS email, trim(razon_social) AS razon_social,
         lpad(CAST(userId AS VARCHAR), 12, '0') AS ruc_emisor, amount_of_hours, rate, description,
         strftime(invoice_date, '%Y') AS year, strftime(invoice_date, '%m') AS month,
         row_number() OVER (PARTITION BY lower(email), date_trunc('month', invoice_date)
                            ORDER BY invoice_id DESC) AS rn
  FROM {decisions} WHERE failures = '') WHERE rn = 1"""

_ROUNDTRIP = _with(
    ["invoices"],
    """
SELECT email, razon_social, ruc_emisor, amount_of_hours, rate, description, year, month FROM (
  SELECT lower(email) AS email, razon_social, lpad(CAST(userId AS VARCHAR), 12, '0') AS ruc_emisor,
         CAST(invoice_id AS DOUBLE) / 4 AS amount_of_hours, rate,
         description || ' said "done", ' || email AS description,
         strftime(invoice_date, '%Y') AS year, strftime(invoice_date, '%m') AS month,
         row_number() OVER (PARTITION BY lower(email), date_trunc('month', invoice_date)
                            ORDER BY invoice_date >= DATE '1998-06-15' DESC, invoice_id DESC) AS rn
  FROM invoices) WHERE rn = 1""",
)

_HOURS_STD = _with(["hours_std"], f"SELECT {_HOURS_COLUMNS} FROM hours_std")

ORACLES: dict[str, str] = {
    "billable_projects": _with(["billable_projects"], "SELECT projectId FROM billable_projects"),
    "billable_hours_by_user": _with(["billable_year"], "SELECT userId, total_billable_hours FROM billable_year"),
    "billable_hours_one_user": _with(
        ["billable_entries"],
        """
SELECT userId, SUM(coalesce(decimalHours, 0.0)) AS total_billable_hours FROM billable_entries
WHERE userId = 7 AND entry_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
GROUP BY userId""",
    ),
    "billable_entries": _with(
        ["billable_entries"], "SELECT projectId, userId, entry_date, decimalHours FROM billable_entries"
    ),
    "landing_hours": _with(
        ["billable_year"],
        """
SELECT CAST(userId AS VARCHAR) AS userId,
       CAST(CAST(round(total_billable_hours, 2) AS DECIMAL(18,2)) AS VARCHAR) AS total_billable_hours,
       '1997-01-01' AS start_date, '1997-12-31' AS end_date, '2025-07-07T15:00:00' AS etl_time
FROM billable_year""",
    ),
    "landing_users": _with(
        ["users_raw"],
        """
SELECT id, coalesce(firstName, '') AS firstName, coalesce(lastName, '') AS lastName,
       coalesce(email, '') AS email, '2025-07-07T15:00:00' AS etl_time FROM users_raw""",
    ),
    "users_std": _with(["users_std"], f"SELECT {_USERS_COLUMNS} FROM users_std"),
    "hours_std": _HOURS_STD,
    "dedupe_latest": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "dedupe_latest_lineitem": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_suppkey, l_partkey
    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC,
             l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
    "merge_latest": _MERGE,
    "merge_latest_small": _MERGE,
    "merge_into_std_table": _MERGE,
    "merge_null_keys": _MERGE_NULLS,
    "qa_consistency": _with(
        _LAYERS,
        f"""
SELECT label, raw_count, std_count,
       CASE WHEN std_count < raw_count THEN 'MISMATCH' ELSE 'OK' END AS status
FROM ({_COUNTS})""",
    ),
    "qa_summary_line": _with(
        _LAYERS,
        f"""
SELECT 'Jul 11, 2025, ' || string_agg(
         CASE WHEN std_count < raw_count THEN '❌ MISMATCH for ' ELSE '✅ Consistency OK for ' END
         || label || ': Raw: ' || raw_count || ' | Std: ' || std_count, ', ' ORDER BY pos) AS report
FROM ({_COUNTS})""",
    ),
    "count_distinct_row": "SELECT COUNT(DISTINCT (l_orderkey, l_linenumber)) AS n FROM lineitem",
    "count_distinct_column": _with(["users_raw"], "SELECT COUNT(DISTINCT id) AS n FROM users_raw"),
    "dashboard_kpis": _with(
        _LAYERS,
        """
SELECT (SELECT COUNT(DISTINCT id) FROM users_std) AS total_users,
       (SELECT round(SUM(total_billable_hours), 2) FROM hours_std) AS total_billable_hours""",
    ),
    "hours_with_email": _with(
        _LAYERS,
        """
SELECT h.userId, h.total_billable_hours, h.start_date, h.end_date, h.etl_time, u.email,
       coalesce(u.email, h.userId) AS display_user
FROM hours_std h LEFT JOIN users_std u ON h.userId = u.id""",
    ),
    "display_users": _with(
        _LAYERS,
        """
SELECT DISTINCT coalesce(u.email, h.userId) AS display_user
FROM hours_std h LEFT JOIN users_std u ON h.userId = u.id
WHERE coalesce(u.email, h.userId) IS NOT NULL""",
    ),
    "user_series": _with(
        _LAYERS,
        """
SELECT coalesce(u.email, h.userId) AS display_user, h.start_date, h.end_date, h.total_billable_hours
FROM hours_std h LEFT JOIN users_std u ON h.userId = u.id
WHERE coalesce(u.email, h.userId) = 'customer.000000007@corp.example'""",
    ),
    "latest_issuer": _with(["latest_issuer"], "SELECT email_key, issuer_company FROM latest_issuer"),
    "latest_issuer_of_email": _with(
        ["latest_issuer"],
        "SELECT issuer_company FROM latest_issuer WHERE email_key = 'customer.000000007@corp.example'",
    ),
    "mapping_append": _with(
        ["mapping"],
        """
SELECT email, issuer_company, updated_at FROM mapping
UNION ALL
SELECT lower(replace(c_name, '#', '.')), c_mktsegment, TIMESTAMP '2025-07-07 15:00:00' FROM customer""",
    ),
    "user_id_by_email": _with(
        ["users_std"],
        """
SELECT o_orderkey AS invoice_id, u.id AS user_id
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN users_std u ON lower(u.email) = lower(replace(c_name, '#', '.')) || '@corp.example'""",
    ),
    "issuer_by_email": _with(
        ["latest_issuer"],
        """
SELECT o_orderkey AS invoice_id, l.issuer_company
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN latest_issuer l ON l.email_key = lower(replace(c_name, '#', '.')) || '@corp.example'""",
    ),
    "email_valid": _with(
        ["users_raw"],
        r"""
SELECT id, lastName,
       regexp_full_match(trim(lower(CASE WHEN lastName LIKE 'renamed%' THEN replace(email, 'corp.', 'corp-')
                                         ELSE email END)), '[\w.-]+@corp\.example') AS valid
FROM users_raw""",
    ),
    "invoice_fields": _with(
        ["invoices"],
        """
SELECT invoice_id,
       CASE WHEN description = 'consulting' THEN 'consulting general' ELSE description END AS description,
       amount_of_hours, rate, CAST(invoice_date AS VARCHAR) AS date,
       lpad(CAST(userId AS VARCHAR), 12, '0') AS ruc_emisor, trim(razon_social) AS razon_social, rut_receptor,
       CAST(NULL AS VARCHAR) AS parse_error
FROM invoices""",
    ),
    "invoice_rules": _with(
        ["invoices", "latest_issuer"],
        """
SELECT invoice_id, lower(trim(razon_social)) = lower(issuer_company) AS issuer_ok,
       rut_receptor = '999999999999' AS receiver_ok,
       concat_ws(', ',
         CASE WHEN lower(description) NOT LIKE '%engineering%' THEN 'engineering' END,
         CASE WHEN lower(description) NOT LIKE '%platform%' THEN 'platform' END,
         CASE WHEN lower(description) NOT LIKE '%reviewed%' THEN 'reviewed' END,
         CASE WHEN lower(description) NOT LIKE '%clause 7 of the frame contract%'
              THEN 'clause 7 of the frame contract' END) AS missing_keywords
FROM invoices LEFT JOIN latest_issuer ON email_key = lower(email)""",
    ),
    "invoice_hours_mtd": _with(
        ["invoices"],
        """
SELECT invoice_id, amount_of_hours, timesheet_hours,
       CASE WHEN timesheet_hours IS NULL THEN 'no_hours'
            WHEN abs(amount_of_hours - timesheet_hours) < 0.01 THEN 'match' ELSE 'mismatch' END AS hours_status
FROM invoices""",
    ),
    "invoice_decisions": _with(
        ["decisions"],
        """
SELECT invoice_id, nullif(split_part(failures, ',', 1), '') AS first_failure, failures,
       failures = '' AS accepted
FROM decisions""",
    ),
    "invoice_store_rows": _with(["decisions"], _STORE.format(decisions="decisions")),
    "invoice_files_to_store": _with(["saved_decisions"], _STORE.format(decisions="saved_decisions")),
    "invoice_store_roundtrip": _ROUNDTRIP,
    "invoice_table_partitions": _ROUNDTRIP,
    "api_pages_flatten": _with(
        ["project_tasks"],
        """
SELECT CAST(id AS VARCHAR) AS id, CAST(projectId AS VARCHAR) AS projectId, isNonBillable FROM project_tasks""",
    ),
    "api_pages_totals": """
SELECT COUNT(*) AS delivered, COUNT(*) AS announced, TRUE AS complete FROM customer""",
    "landing_roundtrip": _with(
        ["users_raw"],
        """
SELECT id, firstName, lastName, email, TIMESTAMP '2025-07-07 15:00:00' AS etl_time FROM users_raw""",
    ),
    "incremental_raw": _HOURS_STD,
    "full_reload": _HOURS_STD,
    "mixed_modes": _HOURS_STD,
    "hydrate_to_std": _with(
        ["billable_year"],
        """
SELECT CAST(userId AS VARCHAR) AS userId, round(total_billable_hours, 2) AS total_billable_hours,
       DATE '1997-01-01' AS start_date, DATE '1997-12-31' AS end_date,
       'Jul 11, 2025, ✅ Consistency OK for users: Raw: ' || n || ' | Std: ' || n
       || ', ✅ Consistency OK for billable_hours_summary: Raw: ' || h || ' | Std: ' || h AS report
FROM billable_year, (SELECT COUNT(*) AS n FROM customer), (SELECT COUNT(*) AS h FROM billable_year)""",
    ),
    "landing_run_folders": _with(
        ["users_raw"],
        """
SELECT folder, COUNT(*) AS n
FROM users_raw, (VALUES ('run=2025-07-07_090000'), ('run=2025-07-07_150000')) AS runs(folder) GROUP BY folder""",
    ),
    "landing_quarantine": """
SELECT 'loaded' AS state, CAST(c_custkey AS VARCHAR) AS line FROM customer WHERE c_custkey % 3 = 0
UNION ALL
SELECT 'set aside', c_custkey || ',' || lower(c_mktsegment) || ',' || replace(c_name, '#', '.')
       || ',a@b.example,again,2025-07-07T15:00:00' FROM customer WHERE c_custkey % 3 = 1
UNION ALL
SELECT 'set aside', c_custkey || ',"' || lower(c_mktsegment) FROM customer WHERE c_custkey % 3 = 2
UNION ALL
SELECT 'set aside', 'and more",' || replace(c_name, '#', '.') || ',a@b.example,2025-07-07T15:00:00'
FROM customer WHERE c_custkey % 3 = 2""",
    "failing_table_beside_a_good_one": _with(
        ["hours_raw"], "SELECT userId, COUNT(*) AS n, 'users:NoLandingFiles' AS failed FROM hours_raw GROUP BY userId"
    ),
    "qa_error_line": _with(
        ["hours_raw", "hours_valid", "hours_std"],
        """
SELECT 'Jul 11, 2025, ❌ Error in users: table not found: no_such_database.users_raw, '
       || CASE WHEN s < r THEN '❌ MISMATCH for ' ELSE '✅ Consistency OK for ' END
       || 'billable_hours_summary: Raw: ' || r || ' | Std: ' || s AS report
FROM (SELECT COUNT(DISTINCT userId) AS r FROM hours_raw), (SELECT COUNT(DISTINCT userId) AS s FROM hours_std)""",
    ),
    "invoice_documents_from_files": _with(
        ["invoices"],
        """
SELECT invoice_id, email, CASE WHEN description = 'consulting' THEN 'consulting general' ELSE description END AS description,
       amount_of_hours, rate, CAST(invoice_date AS VARCHAR) AS date,
       lpad(CAST(userId AS VARCHAR), 12, '0') AS ruc_emisor, trim(razon_social) AS razon_social, rut_receptor,
       CAST(NULL AS VARCHAR) AS parse_error
FROM invoices""",
    ),
    "invoice_hours_from_table": _with(["invoices"], "SELECT invoice_id, timesheet_hours FROM invoices"),
    "invoice_inbox": _with(
        ["saved_decisions"], "SELECT invoice_id, CAST(invoice_id % 2 AS INTEGER) AS run, failures FROM saved_decisions"
    ),
    "qa_consistency_by_keys": _with(
        ["hours_raw", "hours_valid", "hours_std"],
        """
SELECT 'billable_hours_summary' AS label, r AS raw_count, s AS std_count,
       CASE WHEN s < r THEN 'MISMATCH' ELSE 'OK' END AS status
FROM (SELECT COUNT(DISTINCT userId) AS r FROM hours_raw), (SELECT COUNT(DISTINCT userId) AS s FROM hours_std)""",
    ),
}
