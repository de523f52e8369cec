"""The same results as plain SQL over the test tables, to compare the queries with."""

from __future__ import annotations

# Exact decimal average, rounded half up to six and then to two digits, from integers:
# the comparing engine averages decimals as floating point.
_CENTS = "CAST(sum(CAST(round({x} * 100) AS BIGINT)) AS HUGEINT)"


def _micros(money: str, count: str) -> str:
    cents = _CENTS.format(x=money)
    return f"((2 * {cents} * 10000 + {count}) // (2 * {count}))"


def _avg6(money: str, count: str) -> str:
    return f"CAST(CAST({_micros(money, count)} AS DECIMAL(25,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(16,6))"


def _avg2(money: str, count: str) -> str:
    return (
        f"CAST(CAST(({_micros(money, count)} + 5000) // 10000 AS DECIMAL(25,0))"
        f" * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(13,2))"
    )


_SNAPSHOTS = """
snapshots AS (
  SELECT l_orderkey AS employee_id, CAST(l_shipdate AS DATE) AS snapshot_date, l_linenumber AS line_number,
         l_partkey AS dept_id, l_suppkey AS owner_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS salary_annual,
         l_quantity >= 40 AS is_people_manager,
         CASE l_returnflag WHEN 'A' THEN 'full_time' WHEN 'R' THEN 'part_time' ELSE 'contract' END AS employment_type,
         l_linestatus = 'O' AS is_employed
  FROM lineitem
)"""
_EMPLOYEE = f"""{_SNAPSHOTS},
employee AS (
  SELECT * EXCLUDE (r) FROM (
    SELECT *, row_number() OVER (PARTITION BY employee_id ORDER BY snapshot_date DESC, line_number DESC,
      dept_id DESC, owner_id DESC, salary_annual DESC, is_people_manager DESC, employment_type DESC,
      is_employed DESC) AS r
    FROM snapshots)
  WHERE r = 1
)"""
_DEPARTMENT = """
department AS (
  SELECT p_partkey AS dept_id, p_type AS dept_code, p_name AS dept_name, p_brand AS cost_centre,
         p_size > 10 AS is_active
  FROM part
)"""
# A department and the people who work in it, if any, fall into one group.
_GOLD = f"""{_EMPLOYEE},{_DEPARTMENT},
gold AS (
  SELECT dept_id, any_value(dept_code) AS dept_code, any_value(dept_name) AS dept_name,
         any_value(cost_centre) AS cost_centre, any_value(is_active) AS department_active,
         count(employee_id) AS headcount_people, count(*) FILTER (is_people_manager) AS managers,
         count(*) FILTER (employment_type = 'full_time') AS full_time,
         CAST(greatest(0, sum(salary_annual)) AS DECIMAL(23,2)) AS total_salary,
         {_avg2("salary_annual", "nullif(count(salary_annual), 0)")} AS avg_salary
  FROM department LEFT JOIN (FROM employee WHERE is_employed) USING (dept_id)
  GROUP BY dept_id
)"""
_BIZ = "SELECT l_partkey FROM lineitem WHERE CAST(l_suppkey AS VARCHAR) = '1'"
_STATUS = "CASE WHEN failures > 0 THEN 'failed' WHEN population = 0 THEN 'vacuous' ELSE 'passed' END AS status"

_FTE = "CAST(sum(CASE WHEN employment_type = 'full_time' THEN 1.0 ELSE 0.5 END) AS DECIMAL(21,1))"
_FULLTIME = "count(*) FILTER (WHERE employment_type = 'full_time')"
_MANAGERS = "count(*) FILTER (WHERE is_people_manager)"


def _tallies(*parts: str) -> str:
    return f"SELECT check_name, CAST(population AS BIGINT) AS population, CAST(failures AS BIGINT) AS failures, {_STATUS} FROM ({' UNION ALL '.join(parts)})"


_BRONZE_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
       CAST(date_trunc('year', o_orderdate) AS DATE) AS _file_date, CAST(NULL AS VARCHAR) AS _rescued_data
FROM orders"""

# The first label whose condition holds; the labels are fixed values.
_VERDICTS = (
    ("pii IS NULL AND NOT exposed", "REVIEW: unclassified"),
    ("bare AND strangers > 0", "REVIEW: unprotected restricted columns, reader without an approved exception"),
    ("lower(pii) = 'true' AND masks = 0 AND strangers > 0", "REVIEW: unmasked PII, reader without an approved exception"),
    ("readers = 0", "ok — owner only"),
    ("exposed AND NOT bare", "ok — restricted columns protected"),
    ("strangers = 0", "ok — approved exception"),
    ("true", "ok"),
)
_LABELS = ", ".join(f"CASE WHEN {when} THEN '{label}' END" for when, label in _VERDICTS)
# Parts play tables. All that is known of one is worked out by its part key.
_REGISTER = f"""
by_line AS (
  SELECT l_partkey AS k, l_linenumber, max(l_quantity) AS q, max(l_discount) AS d,
         max(l_returnflag) || l_linenumber IN (
           SELECT 'R' || n_nationkey FROM nation
           WHERE n_regionkey = 0 AND any_value(p_size) <= 17
              OR n_regionkey = 2 AND any_value(p_size) > 34
              OR n_regionkey NOT IN (0, 2) AND any_value(p_size) BETWEEN 18 AND 34) AS covered
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_partkey, l_linenumber
),
seen AS (
  SELECT DISTINCT l_partkey AS k, o_custkey AS who FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_quantity >= 48
),
known AS (
  SELECT p.*,
         CASE WHEN p_size > 34 THEN 'gold' WHEN p_size > 17 THEN 'silver' ELSE 'bronze' END AS layer,
         map {{'red': 'true', 'blue': 'True', 'small': 'false'}}[string_split(p_name, ' ')[1]] AS pii,
         (SELECT count(*) FROM by_line WHERE k = p_partkey AND q >= 45) AS classes,
         (SELECT count(*) FROM by_line WHERE k = p_partkey AND q >= 50) AS secrets,
         (SELECT count(*) FROM by_line WHERE k = p_partkey AND q >= 50 AND (d > 0.05 OR covered)) AS safe,
         (SELECT count(*) FROM by_line WHERE k = p_partkey AND q >= 49 AND d > 0.05) AS masks,
         (SELECT count(*) FROM seen WHERE k = p_partkey) AS readers
  FROM part p
),
strange AS (
  SELECT *, (SELECT count(*) FROM seen JOIN customer ON c_custkey = who
             WHERE k = p_partkey AND layer <> CASE c_mktsegment WHEN 'BUILDING' THEN 'bronze' WHEN 'MACHINERY' THEN 'silver' ELSE 'gold' END
            ) AS strangers,
         secrets > 0 AS exposed, secrets > safe AS bare
  FROM known
),
register AS (
  SELECT layer AS table_schema, 'part_' || p_partkey AS table_name, p_brand AS table_owner, p_type AS domain, layer,
         pii AS contains_pii, classes AS classified_columns, secrets AS restricted_columns, safe AS protected_columns,
         masks AS masked_columns, CASE WHEN p_size = 50 THEN 'filter_' || p_brand END AS row_filter,
         readers AS granted_readers, strangers AS unapproved_readers, coalesce({_LABELS}) AS review_flag
  FROM strange
)"""

_MEMBERS = """
members AS (
  SELECT DISTINCT o_orderpriority AS role, 'C' || o_custkey AS member FROM orders
  UNION
  SELECT CASE WHEN s_acctbal > 5000 THEN '1-URGENT' ELSE '5-LOW' END, 'S' || s_suppkey FROM supplier
),
live AS (
  SELECT 'C' || c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal > 0
  UNION ALL SELECT 'S' || s_suppkey, s_name FROM supplier
)"""

ORACLE: dict[str, str] = {
    "ingest_roundtrip": _BRONZE_ORDERS,
    "ingest_twice": _BRONZE_ORDERS,
    "ingest_stream": _BRONZE_ORDERS,
    "ingest_refreshed": _BRONZE_ORDERS,
    "delivered_dates": """
        SELECT make_date(year(o_orderdate), 1, 1) AS business_date, count(*) AS rows, true AS every_file_loaded
        FROM orders GROUP BY 1""",
    "asof_batches": """
        SELECT make_date(year(o_orderdate), 1, 1) AS business_date, count(*) FILTER (o_orderstatus = 'F') AS rows_then,
               count(*) AS rows_today, CAST(0 AS BIGINT) AS rows_lost
        FROM orders GROUP BY 1""",
    "gold_rebuilt": f"WITH {_GOLD} SELECT * FROM gold",
    "gold_merged": f"WITH {_GOLD} SELECT * FROM gold",
    "ingest_evolved": f"""SELECT * REPLACE (CASE WHEN year(o_orderdate) % 2 = 0 THEN o_orderpriority END AS o_orderpriority)
        FROM ({_BRONZE_ORDERS})""",
    "review_copy": """
        SELECT make_date(year(o_orderdate), 1, 1) AS business_date, count(*) AS rows_primary,
               count(*) + count(*) FILTER (o_orderstatus = 'P') AS rows_review
        FROM orders GROUP BY 1""",
    "control_reloaded": """
        SELECT DISTINCT l_suppkey AS principal, l_partkey AS dept_id
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal > 0""",
    "unique_incremental": """
        SELECT l_orderkey, l_linenumber, count(*) AS n, true AS loaded_before
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL""",
    "vacuous_checks": _tallies(*[
        f"SELECT '{lang}.{rule}' AS check_name, count(*) AS population, count(*) FILTER ({bad}) AS failures "
        f"FROM documents WHERE lang = '{lang}'"
        for lang in ("en", "de", "xx")
        for rule, bad in (("not_null_text", "text IS NULL"), ("between_n_chars", "n_chars < 20"))
    ]),
    "ambiguous_columns": """
        SELECT coalesce(string_agg(n, ',' ORDER BY n), 'yes') AS verdict FROM (
          SELECT DISTINCT 't' || p_size || CASE WHEN p_size % 10 = 0 THEN '.Headcount' ELSE '.fte' END AS n
          FROM part WHERE p_size % 10 = 0 OR p_size % 7 = 0)""",
    "undocumented_columns": """
        WITH brands AS (SELECT p_brand, min(p_type) AS t, min(p_size) AS s FROM part GROUP BY p_brand)
        SELECT coalesce(string_agg(n, ',' ORDER BY n), 'yes') AS verdict FROM (
          SELECT 'parts.salary_' || lower(replace(p_brand, '#', '')) AS n FROM brands
          WHERE s % 2 = 1 AND (s % 3 = 0 OR length(trim(t)) < 10))""",
    "open_findings": f"""WITH {_REGISTER}
        SELECT review_flag, count(*) AS tables FROM register WHERE review_flag LIKE 'REVIEW%' GROUP BY ALL""",
    "layout_totals": "SELECT CAST(sum(rows) AS BIGINT) AS rows, 1::BIGINT AS unmeasured FROM (" + " UNION ALL ".join(
        f"SELECT count(*) AS rows FROM {t}"
        for t in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
                  "labels conversations").split()
    ) + ")",
    "silver_merged": f"WITH {_EMPLOYEE} SELECT * FROM employee",
    "delivery_faults": """
        WITH years AS (SELECT DISTINCT year(o_orderdate)::INT AS y FROM orders)
        SELECT check_name, y AS business_year, reason
        FROM years JOIN (VALUES
          (0, 'record_counts', 'declared <> loaded'),
          (1, 'presence', 'delivered, but no .ctrl declares it'), (1, 'record_counts', 'bronze rows with no .ctrl'),
          (2, 'md5', 'other bytes'),
          (3, 'presence', 'delivered, but no .ctrl declares it'), (3, 'record_counts', 'bronze rows with no .ctrl'),
          (3, 'drift', 'rescued')) AS fault(kind, check_name, reason) ON kind = y % 4""",
    "layout_profile": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, count(*) > 0 AS measured FROM {t}"
        for t in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
                  "labels conversations").split()
    ),
    "metric_questions": f"""WITH {_EMPLOYEE},{_DEPARTMENT},
        asked AS (
          SELECT CASE
                   WHEN grouping(cost_centre) = 0 THEN 'cost_centre, department_is_active'
                   WHEN grouping(employment_type) = 0 THEN 'employment_type'
                   WHEN grouping(dept_name) = 0 THEN 'department' ELSE '' END AS grouping,
                 cost_centre, is_active AS department_is_active, employment_type, dept_name AS department,
                 count(*) AS headcount_people, {_FTE} AS headcount_fte, {_FULLTIME} AS headcount_fulltime,
                 CAST(sum(salary_annual) AS DECIMAL(22,2)) AS salary_total,
                 {_avg6("salary_annual", "count(salary_annual)")} AS salary_avg, {_MANAGERS} AS manager_count
          FROM employee e LEFT JOIN department d ON e.dept_id = d.dept_id
          WHERE is_employed
          GROUP BY GROUPING SETS ((), (cost_centre, is_active), (employment_type), (dept_name)))
        SELECT * FROM asked""",
    "id_list": f"""
        SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_partkey IN ({_BIZ}) ORDER BY id""",
    "ctrl_ingest": """
        SELECT 'orders' AS feed, CAST(date_trunc('year', o_orderdate) AS DATE) AS business_date, count(*) AS declared
        FROM orders GROUP BY ALL""",
    "delivery_contract": """
        SELECT check_name, CAST(CASE WHEN n > 0 THEN 0 END AS BIGINT) AS failures,
               CASE WHEN n > 0 THEN 'passed' ELSE 'vacuous' END AS status
        FROM (SELECT count(*) AS n FROM orders),
             (SELECT unnest(['presence', 'record_counts', 'md5', 'drift']) AS check_name)""",
    "watermark_anti": """
        WITH ledger AS (
          SELECT o_orderkey AS k, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS t
          FROM orders WHERE o_orderdate < '1998-01-01')
        SELECT o_orderkey AS _file_path, CAST(o_orderdate AS DATE) AS modified FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.k = o.o_orderkey AND l.t = o.o_orderdate)""",
    "path_date_of": r"""
        WITH p AS (
          SELECT '/landing/feed/' || CASE WHEN l_returnflag = 'N' THEN 'undated' ELSE
            year(l_shipdate) || '-' || lpad(CAST(l_linenumber * 3 AS VARCHAR), 2, '0') || '-' ||
            lpad(CAST(CAST(l_quantity AS INT) AS VARCHAR), 2, '0') END || '/file.csv' AS path
          FROM lineitem)
        SELECT TRY_CAST(regexp_extract(path, '/(\d{4}-\d{2}-\d{2})/', 1) AS DATE) AS file_date, count(*) AS n
        FROM p GROUP BY ALL""",
    "settled_files": """
        SELECT event_id AS file_id FROM events
        WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 90 SECOND""",
    "ctrl_presence": """
        WITH disk AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linestatus = 'O'),
             declared AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'O')
        SELECT '/landing/orders' AS directory, k || '.csv' AS file_name,
               'delivered, but no .ctrl declares it' AS reason
        FROM disk WHERE k NOT IN (SELECT k FROM declared)
        UNION ALL
        SELECT '/landing/orders', k || '.csv', 'declared by a .ctrl, but not on disk'
        FROM declared WHERE k NOT IN (SELECT k FROM disk)""",
    "ctrl_reconcile": """
        SELECT 'orders' AS model, '/landing/orders' AS directory, k || '.csv' AS file_name,
               max(said) AS declared, CAST(nullif(sum(line), 0) AS BIGINT) AS loaded,
               CASE max(sent) WHEN 0 THEN 'bronze rows with no .ctrl' ELSE
                 coalesce(max('declared <> loaded') FILTER (WHERE said IS NOT NULL), 'declared count is NULL') END AS reason
        FROM (
          SELECT o_orderkey AS k, 1 AS sent, 0 AS line,
                 CAST(floor(o_totalprice / 100000) AS BIGINT) + CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL ELSE 0 END AS said
          FROM orders WHERE o_orderstatus IN ('O', 'F')
          UNION ALL SELECT l_orderkey, 0, 1, NULL FROM lineitem)
        GROUP BY k HAVING max(said) IS DISTINCT FROM sum(line)""",
    "ctrl_md5": """
        WITH f AS (
          SELECT CAST(d.doc_id AS VARCHAR) AS file_name, md5(text) AS actual_md5,
                 CASE quality WHEN 1 THEN md5(text) WHEN 0 THEN md5(replace(text, ' ', '')) END AS declared_md5
          FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
        SELECT '/landing/documents' AS directory, file_name, declared_md5, actual_md5 FROM f
        WHERE declared_md5 IS NULL OR declared_md5 <> actual_md5""",
    "dates_disagree": """
        SELECT 'documents: n_chars <> n_bytes' AS check_name, CAST(doc_id AS VARCHAR) AS _file_name,
               CAST(n_chars AS VARCHAR) AS a, CAST(strlen(text) AS VARCHAR) AS b
        FROM documents WHERE n_chars <> strlen(text)""",
    "event_order": _tallies("""
        SELECT 'event_order' AS check_name, count(*) AS population,
               count(*) FILTER (WHERE CAST(o_orderdate AS DATE) > CAST(l_shipdate AS DATE)) AS failures
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "silver_current": f"WITH {_EMPLOYEE} SELECT * FROM employee",
    "silver_current_dim": """
        SELECT user_id, event_id, event_type, value FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
        WHERE r = 1""",
    "gold_headcount": f"WITH {_GOLD} SELECT * FROM gold",
    "silver_uniqueness": f"WITH {_EMPLOYEE},{_DEPARTMENT} " + _tallies(
        "SELECT 'employee' AS check_name, count(*) AS population, count(*) - count(DISTINCT employee_id) AS failures FROM employee",
        "SELECT 'department', count(*), count(*) - count(DISTINCT dept_id) FROM department",
    ),
    "duplicate_keys": """
        SELECT 'lineitem' AS model, CAST(l_orderkey AS VARCHAR) AS k, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1
        UNION ALL SELECT 'events', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY ALL HAVING count(*) > 1
        UNION ALL SELECT 'documents', CAST(doc_id AS VARCHAR), count(*) FROM documents GROUP BY ALL HAVING count(*) > 1""",
    "unique_combo": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "not_null": f"WITH {_GOLD} " + _tallies(*[
        f"SELECT 'gold.not_null_{c}' AS check_name, count(*) AS population, count(*) - count({c}) AS failures FROM gold"
        for c in ("dept_id", "dept_name", "headcount_people", "avg_salary")
    ]),
    "range_check": _tallies(
        "SELECT 'customer.between_c_acctbal' AS check_name, count(*) AS population, count(*) FILTER (WHERE c_acctbal < 0) AS failures FROM customer",
        "SELECT 'lineitem.between_l_quantity', count(*), count(*) FILTER (WHERE l_quantity < 10) FROM lineitem",
        "SELECT 'lineitem.between_l_discount', count(*), count(*) FILTER (WHERE l_discount < 0) FROM lineitem",
        "SELECT 'lineitem.not_null_l_tax', count(*), count(*) FILTER (WHERE l_tax IS NULL) FROM lineitem",
    ),
    "fk_check": """
        SELECT o_orderkey FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "silver_picked": """
        SELECT 'employee' AS entity, CAST(l_orderkey AS VARCHAR) AS k, CAST(min(l_shipdate) AS DATE) AS picked,
               CAST(max(l_shipdate) AS DATE) AS available
        FROM lineitem GROUP BY l_orderkey HAVING CAST(min(l_shipdate) AS DATE) <> CAST(max(l_shipdate) AS DATE)""",
    "gold_reconciles": f"""WITH {_EMPLOYEE}
        SELECT count(*) AS expected, nullif(count(*) FILTER (p_size > 10), 0) AS actual,
               (SELECT count(*) FROM part WHERE p_size > 10) AS rows_in_gold
        FROM employee LEFT JOIN part ON p_partkey = dept_id
        WHERE is_employed HAVING count(*) > count(*) FILTER (p_size > 10)""",
    "metric_totals": f"""WITH {_EMPLOYEE}
        SELECT count(*) AS headcount_people, {_FTE} AS headcount_fte, {_FULLTIME} AS headcount_fulltime,
               CAST(sum(salary_annual) AS DECIMAL(22,2)) AS salary_total,
               {_avg6("salary_annual", "count(salary_annual)")} AS salary_avg, {_MANAGERS} AS manager_count
        FROM employee WHERE is_employed""",
    "metric_by_dim": f"""WITH {_EMPLOYEE},{_DEPARTMENT}
        SELECT cost_centre, is_active AS department_is_active, count(*) AS headcount_people, {_FTE} AS headcount_fte,
               {_FULLTIME} AS headcount_fulltime, CAST(sum(salary_annual) AS DECIMAL(22,2)) AS salary_total
        FROM employee e LEFT JOIN department d ON e.dept_id = d.dept_id
        WHERE is_employed GROUP BY ALL ORDER BY headcount_people DESC""",
    "metric_by_type": f"""WITH {_EMPLOYEE}
        SELECT employment_type, count(*) AS headcount_people FROM employee WHERE is_employed GROUP BY ALL""",
    "metric_distinct": f"""WITH {_EMPLOYEE},
        people AS (SELECT employment_type = 'full_time' AS complete FROM employee WHERE is_employed),
        totals AS (SELECT count(*) AS p, count(*) - 0.5 * count(*) FILTER (NOT complete) AS f, count(*) FILTER (complete) AS t FROM people)
        SELECT p AS headcount_people, CAST(f AS DECIMAL(21,1)) AS headcount_fte, t AS headcount_fulltime,
               if(len(list_distinct([CAST(p AS DOUBLE), CAST(f AS DOUBLE), CAST(t AS DOUBLE)])) = 3, 'yes', 'no') AS verdict
        FROM totals""",
    "metric_masked": f"""WITH {_EMPLOYEE}
        SELECT count(*) AS headcount_people, CAST(NULL AS DECIMAL(22,2)) AS salary_total,
               CAST(NULL AS DECIMAL(16,6)) AS salary_avg, {_MANAGERS} AS manager_count
        FROM employee WHERE is_employed""",
    "top_managers": f"""WITH {_EMPLOYEE},{_DEPARTMENT}
        SELECT cost_centre, {_MANAGERS} AS manager_count
        FROM employee e LEFT JOIN department d ON e.dept_id = d.dept_id
        WHERE is_employed GROUP BY ALL ORDER BY manager_count DESC, cost_centre LIMIT 5""",
    "mask_salary": """
        SELECT principal, outcome, CASE outcome WHEN 'ROWS' THEN people END AS people,
               CASE WHEN outcome = 'ROWS' THEN if(plain, readable, 0) END AS readable
        FROM (SELECT count(*) AS people, count(c_acctbal) AS readable FROM customer),
             (VALUES ('steward', 'ROWS', true), ('pipeline', 'ROWS', true), ('hr-analyst', 'ROWS', false), ('1', 'DENIED', false))
               AS caller(principal, outcome, plain)""",
    "mask_email": """
        SELECT c_custkey AS employee_id, '***#' || coalesce(nullif(split_part(c_name, '#', 2), ''), 'redacted') AS email
        FROM customer""",
    "tag_mask": """
        SELECT 'steward' AS principal, 'ROWS' AS outcome, c_mktsegment AS gender, count(*) AS people FROM customer GROUP BY ALL
        UNION ALL SELECT 'hr-analyst', 'ROWS', 'REDACTED', count(*) FROM customer
        UNION ALL SELECT '1', 'DENIED', NULL, NULL""",
    "row_filter_biz": f"""WITH {_GOLD}
        SELECT dept_id, dept_code, dept_name, cost_centre, department_active, headcount_people, managers, full_time,
               CAST(NULL AS DECIMAL(23,2)) AS total_salary, CAST(NULL AS DECIMAL(13,2)) AS avg_salary
        FROM gold WHERE dept_id IN ({_BIZ})""",
    "visible_ids": f"WITH mapped AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE CAST(l_suppkey AS VARCHAR) = '1') " + _tallies(
        "SELECT 'biz' AS check_name, (SELECT count(*) FROM mapped) AS population, 0 AS failures",
        "SELECT 'steward', (SELECT count(*) FROM mapped), (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT k FROM mapped))",
    ),
    "layer_equals_gold": f"""WITH {_GOLD},
        a AS (SELECT count(*) AS n FROM employee WHERE is_employed AND dept_id IN ({_BIZ})),
        b AS (SELECT coalesce(CAST(sum(headcount_people) AS BIGINT), 0) AS n FROM gold WHERE dept_id IN ({_BIZ}))
        SELECT a.n AS layer_total, b.n AS table_total, CASE WHEN a.n = b.n THEN 'yes' ELSE 'no' END AS verdict
        FROM a CROSS JOIN b""",
    "prove_principals": f"""WITH {_GOLD},
        total AS (SELECT count(*) AS departments, CAST(sum(headcount_people) AS BIGINT) AS people,
                         CAST(sum(total_salary) AS DECIMAL(33,2)) AS payroll, max(avg_salary) AS highest_avg FROM gold),
        own AS (SELECT count(*) AS departments, CAST(sum(headcount_people) AS BIGINT) AS people
                FROM gold WHERE dept_id IN ({_BIZ}))
        SELECT 'steward' AS principal, 'ROWS' AS outcome, * FROM total
        UNION ALL SELECT 'pipeline', 'ROWS', * FROM total
        UNION ALL SELECT 'hr-analyst', 'ROWS', departments, people, NULL, NULL FROM total
        UNION ALL SELECT '1', 'ROWS', departments, people, NULL, NULL FROM own
        UNION ALL SELECT 'outsider', 'DENIED', NULL, NULL, NULL, NULL""",
    "stewardship": f"WITH {_REGISTER} SELECT * FROM register",
    "register_findings": f"""WITH {_REGISTER}
        SELECT table_schema, review_flag, count(*) AS tables FROM register GROUP BY ALL""",
    "unapproved_bronze_readers": f"""WITH {_REGISTER}
        SELECT table_name, unapproved_readers FROM register
        WHERE table_schema = 'bronze' AND contains_pii = 'true' AND unapproved_readers > 0""",
    "effective_grants": f"""WITH {_MEMBERS},
        grants AS (SELECT DISTINCT o_orderpriority AS role, 'SELECT' AS privilege,
                     CASE o_orderstatus WHEN 'O' THEN 'gold' WHEN 'F' THEN 'silver' ELSE 'governance' END AS schema_name
                   FROM orders)
        SELECT g.role, l.name AS grantee, privilege, schema_name
        FROM grants g JOIN members m ON m.role = g.role JOIN live l ON l.id = m.member""",
    "roles_without_members": f"""WITH {_MEMBERS},
        granted AS (
          SELECT DISTINCT o_orderpriority AS role, 'SELECT' AS privilege,
                 CASE o_orderstatus WHEN 'O' THEN 'gold' WHEN 'F' THEN 'silver' ELSE 'governance' END AS schema_name
          FROM orders
          UNION SELECT p_brand, 'SELECT', 'gold' FROM part),
        rich AS (SELECT DISTINCT role, member FROM members JOIN customer ON member = 'C' || c_custkey WHERE c_acctbal > 9000)
        SELECT role, count(*) AS grants,
               CASE WHEN role IN (SELECT role FROM rich) THEN 'no member is a live principal' ELSE 'no members' END AS reason
        FROM granted WHERE role NOT IN (SELECT role FROM rich JOIN live ON id = member) GROUP BY role""",
    "stale_grants": f"""WITH {_MEMBERS}
        SELECT DISTINCT member AS grantee FROM members WHERE member NOT IN (SELECT id FROM live)""",
    "tag_vocabulary": """
        SELECT tag_name, tag_value, count(*) AS uses FROM (
          SELECT 'lang' AS tag_name, lang AS tag_value FROM documents
          UNION ALL SELECT 'event', event_type FROM events)
        WHERE (tag_name = 'lang' AND tag_value NOT IN ('en', 'de', 'fr'))
           OR (tag_name = 'event' AND tag_value NOT IN ('view', 'click', 'purchase'))
        GROUP BY ALL""",
    "op_mix": """
        SELECT 't' || user_id AS table_name, event_type AS operation, count(*) AS commits FROM events GROUP BY ALL""",
    "growth": """
        WITH h AS (SELECT 't' || user_id AS table_name, event_id, event_type FROM events)
        SELECT table_name, count(*) AS versions, min(event_id) AS oldest_version,
               arg_max(event_type, event_id) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS last_build_op,
               coalesce(last_build_op = 'purchase', false) AS accumulates_files
        FROM h GROUP BY table_name""",
    "asof_subset": """
        SELECT count(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-15 00:00:00') AS rows_as_of, count(*) AS rows_today,
               rows_as_of <= rows_today AS subset FROM events""",
    "stable_ids": """
        SELECT doc_id, substr(sha256(source || '|' || lang || '|' || text), 1, 32) AS id FROM documents""",
}
