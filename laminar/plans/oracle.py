"""DuckDB twins of the registered queries (the correctness oracle).

The driver tables are pre-registered as views. The raw-layer binding and the
cleaning rules are restated as CTEs, and every query selects from them. Column
names and types are aligned with the Spark results: decimal sums as
DECIMAL(20,2), integer sums and counts as BIGINT, means as DOUBLE sum / count.
"""

from __future__ import annotations

from laminar.functions.rules import SCALE_CATEGORY_RULES

TS = "'%Y-%m-%d %H:%M:%S'"
DAY = "'%Y-%m-%d'"


def _category_case(column: str) -> str:
    whens = " ".join(f"WHEN contains({column}, '{k}') THEN '{v}'" for k, v in SCALE_CATEGORY_RULES)
    return f"CASE {whens} ELSE 'OTHER' END"


def _date(col: str) -> str:
    return f"CAST(TRY_CAST({col} AS TIMESTAMP) AS DATE)"


ODS_USER_INFO = f"""
ods_user_info AS (
  SELECT
    CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS user_id,
    c_name AS username,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name || '@example.com' END AS email,
    CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE lpad(CAST(c_custkey AS VARCHAR), 11, '0') END AS phone,
    CASE WHEN c_custkey % 101 = 0 THEN 'bad-date' ELSE strftime(base, {DAY}) || ' 10:30:00' END AS register_time,
    strftime(base + 30, {DAY}) || ' 10:30:00' AS last_login_time,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'active' WHEN 'MACHINERY' THEN 'vip'
                      WHEN 'AUTOMOBILE' THEN 'premium' WHEN 'FURNITURE' THEN 'inactive' END AS status,
    strftime(base, {DAY}) || ' 10:30:00' AS create_time,
    strftime(base + 30, {DAY}) || ' 10:30:00' AS update_time,
    strftime(base, {DAY}) AS dt
  FROM (SELECT *, DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS base FROM customer) c
)"""

ODS_ORDER_INFO = f"""
ods_order_info AS (
  SELECT
    CASE WHEN (l_orderkey + l_partkey) % 101 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS order_id,
    CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
    CAST(l_partkey AS VARCHAR) AS product_id,
    p_name AS product_name,
    CASE WHEN l_partkey % 59 = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
    CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
    CASE WHEN l_partkey % 53 = 0 THEN CAST(0 AS DECIMAL(10,2)) ELSE CAST(l_extendedprice AS DECIMAL(10,2)) END AS total_amount,
    o_orderstatus AS order_status,
    o_orderpriority AS payment_method,
    strftime(o_orderdate, {TS}) AS order_time,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(l_shipdate, {TS}) END AS payment_time,
    strftime(o_orderdate, {TS}) AS create_time,
    strftime(o_orderdate, {DAY}) AS dt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""

DWD_USER_INFO = f"""
dwd_user_info AS (
  SELECT user_id, username, email, phone,
    {_date('register_time')} AS register_date,
    {_date('last_login_time')} AS last_login_date,
    status,
    CASE WHEN status = 'active' THEN TRUE ELSE FALSE END AS is_active,
    CASE WHEN status = 'vip' THEN 'VIP' WHEN status = 'premium' THEN 'Premium' ELSE 'Regular' END AS user_level,
    TRY_CAST(create_time AS TIMESTAMP) AS create_time,
    TRY_CAST(update_time AS TIMESTAMP) AS update_time,
    dt
  FROM ods_user_info
  WHERE user_id IS NOT NULL
)"""

DWD_ORDER_INFO = f"""
dwd_order_info AS (
  SELECT order_id, user_id, product_id, product_name,
    {_category_case('product_name')} AS category_id,
    quantity, unit_price, total_amount,
    CAST(0 AS DECIMAL(10,2)) AS discount_amount,
    CAST(total_amount - CAST(0 AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS final_amount,
    order_status, payment_method,
    {_date('order_time')} AS order_date,
    {_date('payment_time')} AS payment_date,
    TRY_CAST(create_time AS TIMESTAMP) AS create_time,
    dt
  FROM ods_order_info
  WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND total_amount > 0
)"""

DWS_USER_DAILY_STATS = """
dws_user_daily_stats AS (
  SELECT user_id,
    CAST(0 AS BIGINT) AS login_count,
    COUNT(order_id) AS order_count,
    CAST(SUM(final_amount) AS DECIMAL(20,2)) AS total_amount,
    CAST(SUM(final_amount) AS DOUBLE) / CAST(COUNT(final_amount) AS DOUBLE) AS avg_order_amount,
    MIN(create_time) AS first_order_time,
    MAX(create_time) AS last_order_time,
    CAST(dt AS DATE) AS stat_date,
    dt
  FROM dwd_order_info
  GROUP BY dt, user_id
)"""

DWS_PRODUCT_DAILY_STATS = """
dws_product_daily_stats AS (
  SELECT product_id, product_name, category_id,
    COUNT(order_id) AS order_count,
    CAST(SUM(quantity) AS BIGINT) AS total_quantity,
    CAST(SUM(final_amount) AS DECIMAL(20,2)) AS total_amount,
    CAST(SUM(unit_price) AS DOUBLE) / CAST(COUNT(unit_price) AS DOUBLE) AS avg_price,
    COUNT(DISTINCT user_id) AS unique_users,
    CAST(dt AS DATE) AS stat_date,
    dt
  FROM dwd_order_info
  GROUP BY dt, product_id, product_name, category_id
)"""

LAYERS = [ODS_USER_INFO, ODS_ORDER_INFO, DWD_USER_INFO, DWD_ORDER_INFO,
          DWS_USER_DAILY_STATS, DWS_PRODUCT_DAILY_STATS]


def with_layers(select: str, extra_ctes: list[str] | None = None) -> str:
    ctes = LAYERS + (extra_ctes or [])
    return "WITH " + ",".join(ctes) + "\n" + select


def _preview(table: str, columns: tuple[str, ...], k: int) -> str:
    cols = ", ".join(columns)
    order = ", ".join(f"{c} ASC NULLS LAST" for c in columns)
    return with_layers(f"""
SELECT * FROM (
  SELECT dt, {cols}, ROW_NUMBER() OVER (PARTITION BY dt ORDER BY {order}) AS rank_in_day
  FROM {table}
) WHERE rank_in_day <= {k}""")


def _count_by_day(layer: str, table: str) -> str:
    return (f"SELECT '{layer}' AS layer, '{table}' AS table_name, dt, COUNT(*) AS row_count "
            f"FROM {table} GROUP BY dt")


LAYER_ROW_COUNTS = with_layers("\nUNION ALL\n".join([
    _count_by_day("DWD", "dwd_user_info"), _count_by_day("DWD", "dwd_order_info"),
    _count_by_day("DWS", "dws_user_daily_stats"), _count_by_day("DWS", "dws_product_daily_stats"),
]))


def _base_sql() -> dict[str, str]:
    from laminar.plans.registry import ORDER_PREVIEW_COLUMNS, USER_PREVIEW_COLUMNS
    out = {name: with_layers(f"SELECT * FROM {name}") for name in (
        "ods_user_info", "ods_order_info", "dwd_user_info", "dwd_order_info",
        "dws_user_daily_stats", "dws_product_daily_stats")}
    out["preview_top_k"] = _preview("ods_order_info", ORDER_PREVIEW_COLUMNS, 5)
    out["preview_users_top_k"] = _preview("ods_user_info", USER_PREVIEW_COLUMNS, 3)
    out["layer_row_counts"] = LAYER_ROW_COUNTS
    return out


# ---------------------------------------------------------------- data quality
def _dq_profile_sql() -> str:
    from laminar.operators.quality import CHECKED_TABLES
    from laminar.schemas import TABLES
    parts = []
    for t in CHECKED_TABLES:
        cols = TABLES[t].columns
        counts = ", ".join(f"COUNT(*) - COUNT({c}) AS {c}" for c in cols)
        parts.append(f"""
  SELECT dt AS check_date, '{t}' AS table_name, column_name, total_count, null_count
  FROM (SELECT dt, COUNT(*) AS total_count, {counts} FROM {t} GROUP BY dt)
  UNPIVOT (null_count FOR column_name IN ({', '.join(cols)}))""")
    body = "\n  UNION ALL".join(parts)
    return f"""
dq_profile AS (
  SELECT check_date, table_name, column_name, total_count, null_count,
    CAST(null_count AS DOUBLE) / CAST(total_count AS DOUBLE) AS null_ratio,
    CAST(null_count AS DOUBLE) / CAST(total_count AS DOUBLE) > CAST(0.1 AS DOUBLE) AS breached
  FROM ({body})
)"""


DQ_USER_CONSISTENCY = """
dq_user_consistency AS (
  SELECT COALESCE(o.dt, d.dt) AS check_date,
    COALESCE(o.n, 0) AS ods_users, COALESCE(d.n, 0) AS dwd_users,
    COALESCE(o.n, 0) = COALESCE(d.n, 0) AS consistent
  FROM (SELECT dt, COUNT(DISTINCT user_id) AS n FROM ods_user_info GROUP BY dt) o
  FULL OUTER JOIN (SELECT dt, COUNT(DISTINCT user_id) AS n FROM dwd_user_info GROUP BY dt) d ON o.dt = d.dt
)"""

DQ_ORDER_RETENTION = """
dq_order_retention AS (
  SELECT check_date, ods_rows, dwd_rows, retention_ratio,
    retention_ratio < CAST(0.95 AS DOUBLE) AS breached
  FROM (
    SELECT COALESCE(o.dt, d.dt) AS check_date,
      COALESCE(o.n, 0) AS ods_rows, COALESCE(d.n, 0) AS dwd_rows,
      CASE WHEN COALESCE(o.n, 0) > 0 THEN CAST(COALESCE(d.n, 0) AS DOUBLE) / CAST(o.n AS DOUBLE)
           ELSE CAST(0.0 AS DOUBLE) END AS retention_ratio
    FROM (SELECT dt, COUNT(*) AS n FROM ods_order_info GROUP BY dt) o
    FULL OUTER JOIN (SELECT dt, COUNT(*) AS n FROM dwd_order_info GROUP BY dt) d ON o.dt = d.dt
  )
)"""


def _dq_accuracy_sql(as_of: str, min_date: str) -> str:
    return f"""
dq_accuracy AS (
  SELECT dt AS check_date,
    CAST(COUNT_IF(total_amount <= 0 OR unit_price <= 0 OR quantity <= 0) AS BIGINT) AS invalid_amounts,
    CAST(COUNT_IF(order_date > DATE '{as_of}' OR order_date < DATE '{min_date}') AS BIGINT) AS invalid_dates
  FROM dwd_order_info GROUP BY dt
)"""


def _dq_findings_sql() -> str:
    from laminar.operators.quality import CHECKED_TABLES
    empties = "\n  UNION ALL".join(f"""
  SELECT check_date, 'empty_partition' AS check_name, '{t}' AS table_name, CAST(NULL AS VARCHAR) AS column_name,
    CAST(0.0 AS DOUBLE) AS metric, CAST(NULL AS DOUBLE) AS threshold, 'FAIL' AS severity
  FROM dq_dates WHERE check_date NOT IN (SELECT dt FROM {t})""" for t in CHECKED_TABLES)
    return f"""
dq_dates AS (SELECT dt AS check_date FROM ods_user_info UNION SELECT dt FROM ods_order_info),
dq_findings AS ({empties}
  UNION ALL
  SELECT check_date, 'null_ratio', table_name, column_name, null_ratio, CAST(0.1 AS DOUBLE), 'WARN'
  FROM dq_profile WHERE breached
  UNION ALL
  SELECT check_date, 'user_consistency', 'dwd_user_info', 'user_id',
    CAST(dwd_users - ods_users AS DOUBLE), CAST(0.0 AS DOUBLE), 'WARN'
  FROM dq_user_consistency WHERE NOT consistent
  UNION ALL
  SELECT check_date, 'order_retention', 'dwd_order_info', NULL, retention_ratio, CAST(0.95 AS DOUBLE), 'WARN'
  FROM dq_order_retention WHERE breached
  UNION ALL
  SELECT check_date, 'amount_accuracy', 'dwd_order_info', NULL, CAST(invalid_amounts AS DOUBLE), CAST(0.0 AS DOUBLE), 'WARN'
  FROM dq_accuracy WHERE invalid_amounts > 0
  UNION ALL
  SELECT check_date, 'date_accuracy', 'dwd_order_info', 'order_date', CAST(invalid_dates AS DOUBLE), CAST(0.0 AS DOUBLE), 'WARN'
  FROM dq_accuracy WHERE invalid_dates > 0
)"""


def dq_sql(as_of: str, min_date: str) -> dict[str, str]:
    ctes = [_dq_profile_sql(), DQ_USER_CONSISTENCY, DQ_ORDER_RETENTION, _dq_accuracy_sql(as_of, min_date),
            _dq_findings_sql()]
    report = """
SELECT d.check_date,
  CAST(6 - COALESCE(f.unchecked, 0) AS BIGINT) AS tables_checked,
  CAST(COALESCE(f.fail_count, 0) AS BIGINT) AS fail_count,
  CAST(COALESCE(f.warn_count, 0) AS BIGINT) AS warn_count,
  CASE WHEN COALESCE(f.fail_count, 0) > 0 THEN 'FAIL' ELSE 'PASS' END AS overall_status
FROM dq_dates d LEFT JOIN (
  SELECT check_date,
    COUNT_IF(severity = 'FAIL') AS fail_count,
    COUNT_IF(severity = 'WARN') AS warn_count,
    COUNT_IF(check_name IN ('empty_partition', 'table_missing')) AS unchecked
  FROM dq_findings GROUP BY check_date
) f ON d.check_date = f.check_date"""
    return {
        "dq_completeness": with_layers("SELECT * FROM dq_profile", ctes),
        "dq_user_consistency": with_layers("SELECT * FROM dq_user_consistency", ctes),
        "dq_order_retention": with_layers("SELECT * FROM dq_order_retention", ctes),
        "dq_accuracy": with_layers("SELECT * FROM dq_accuracy", ctes),
        "dq_findings": with_layers("SELECT * FROM dq_findings", ctes),
        "dq_report": with_layers(report, ctes),
    }



# ---------------------------------------------------------------- tier B
LOGIN_COUNT = """
WITH ev AS (SELECT event_id, user_id, event_type, value, ts, strftime(ts, '%Y-%m-%d') AS dt FROM events),
purch AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id,
    CAST(value AS DECIMAL(10,2)) AS final_amount, ts AS create_time, dt
  FROM ev WHERE event_type = 'purchase'),
views AS (
  SELECT dt, CAST(user_id AS VARCHAR) AS user_id, COUNT(*) AS login_count
  FROM ev WHERE event_type = 'view' GROUP BY dt, CAST(user_id AS VARCHAR)),
s AS (
  SELECT dt, user_id, COUNT(order_id) AS order_count,
    CAST(SUM(final_amount) AS DECIMAL(20,2)) AS total_amount,
    CAST(SUM(final_amount) AS DOUBLE) / CAST(COUNT(final_amount) AS DOUBLE) AS avg_order_amount,
    MIN(create_time) AS first_order_time, MAX(create_time) AS last_order_time
  FROM purch GROUP BY dt, user_id)
SELECT s.user_id, CAST(COALESCE(v.login_count, 0) AS BIGINT) AS login_count, s.order_count, s.total_amount,
  s.avg_order_amount, s.first_order_time, s.last_order_time, CAST(s.dt AS DATE) AS stat_date, s.dt
FROM s LEFT JOIN views v ON s.dt = v.dt AND s.user_id = v.user_id"""


def _dim_date_sql() -> str:
    from laminar.operators.dims import FIXED_HOLIDAYS
    hol = ", ".join(f"'{h}'" for h in FIXED_HOLIDAYS)
    return with_layers(f"""
SELECT strftime(full_date, '%Y%m%d') AS date_key, full_date,
  CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
  CAST(month(full_date) AS INTEGER) AS month, CAST(week(full_date) AS INTEGER) AS week,
  CAST(day(full_date) AS INTEGER) AS day, CAST(isodow(full_date) AS INTEGER) AS weekday,
  isodow(full_date) >= 6 AS is_weekend,
  strftime(full_date, '%m-%d') IN ({hol}) AS is_holiday,
  CASE WHEN month(full_date) IN (3, 4, 5) THEN 'spring' WHEN month(full_date) IN (6, 7, 8) THEN 'summer'
       WHEN month(full_date) IN (9, 10, 11) THEN 'autumn' ELSE 'winter' END AS season,
  monthname(full_date) AS month_name, dayname(full_date) AS weekday_name
FROM (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS full_date
  FROM (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM dwd_order_info) WHERE lo IS NOT NULL
)""")


def _ads_user_behavior_sql(as_of: str, bad: tuple[str, ...], run_ts: str) -> str:
    bad_list = ", ".join(f"'{b}'" for b in bad)
    days = f"(DATE '{as_of}' - u.first_order_date + 1)"
    return with_layers(f"""
SELECT u.user_id, u.total_orders, u.total_amount,
  CAST(u.total_amount AS DOUBLE) / CAST(u.total_orders AS DOUBLE) AS avg_order_amount,
  u.first_order_date, u.last_order_date,
  CAST(LEAST((u.total_orders * 30 * 200 + {days}) // (2 * {days}), 99999) AS DOUBLE) / CAST(100 AS DOUBLE) AS order_frequency,
  CASE WHEN DATE '{as_of}' - u.first_order_date <= 30 THEN 'new'
       WHEN DATE '{as_of}' - u.last_order_date <= 30 THEN 'active'
       WHEN DATE '{as_of}' - u.last_order_date <= 90 THEN 'dormant'
       ELSE 'churned' END AS user_lifecycle,
  p.category_id AS preferred_category,
  CASE WHEN u.bad_orders * 2 > u.total_orders THEN 'high'
       WHEN u.bad_orders * 5 > u.total_orders THEN 'medium' ELSE 'low' END AS risk_level,
  TIMESTAMP '{run_ts}' AS create_time
FROM ads1_u u JOIN ads1_pref p ON u.user_id = p.user_id""", [f"""
ads1_o AS (SELECT * FROM dwd_order_info WHERE order_date <= DATE '{as_of}')""", """
ads1_pc AS (SELECT user_id, category_id, COUNT(order_id) AS n, SUM(final_amount) AS amt
            FROM ads1_o GROUP BY user_id, category_id)""", """
ads1_pref AS (SELECT user_id, category_id FROM (
  SELECT user_id, category_id,
    ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY n DESC, amt DESC, category_id ASC) AS rn
  FROM ads1_pc) WHERE rn = 1)""", f"""
ads1_u AS (SELECT user_id, COUNT(order_id) AS total_orders,
  CAST(SUM(final_amount) AS DECIMAL(20,2)) AS total_amount,
  MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
  COUNT_IF(order_status IN ({bad_list})) AS bad_orders
  FROM ads1_o GROUP BY user_id)"""])


def _ads_sales_trend_sql(run_ts: str) -> str:
    g = "(abs(c_now - c_prev) * 20000 + c_prev) // (2 * c_prev)"
    return with_layers(f"""
SELECT stat_date, total_orders, CAST(total_amount AS DECIMAL(20,2)) AS total_amount,
  CAST(total_amount AS DOUBLE) / CAST(n AS DOUBLE) AS avg_order_amount,
  CAST(COALESCE(new_users, 0) AS BIGINT) AS new_users,
  CAST(COALESCE(active_users, 0) AS BIGINT) AS active_users,
  CASE WHEN prev_users > 0 THEN
    CAST((COALESCE(retained, 0) * 20000 + prev_users) // (2 * prev_users) AS DOUBLE) / CAST(10000 AS DOUBLE) END AS retention_rate,
  CASE WHEN c_prev > 0 AND {g} <= 99999 THEN
    CAST(sign(c_now - c_prev) * {g} AS DOUBLE) / CAST(10000 AS DOUBLE) END AS growth_rate,
  TIMESTAMP '{run_ts}' AS create_time,
  CAST(year(stat_date) AS INTEGER) AS year, CAST(month(stat_date) AS INTEGER) AS month
FROM (
  SELECT d.*, a.active_users, nw.new_users, r.retained, p.prev_users,
    CAST(d.total_amount * 100 AS BIGINT) AS c_now, CAST(p.prev_amount * 100 AS BIGINT) AS c_prev
  FROM ads2_daily d
  LEFT JOIN ads2_active a ON d.stat_date = a.stat_date
  LEFT JOIN ads2_new nw ON d.stat_date = nw.stat_date
  LEFT JOIN ads2_ret r ON d.stat_date = r.stat_date
  LEFT JOIN ads2_prev p ON d.stat_date = p.stat_date
)""", ["""
ads2_o AS (SELECT * FROM dwd_order_info WHERE order_date IS NOT NULL)""", """
ads2_daily AS (SELECT order_date AS stat_date, COUNT(order_id) AS total_orders,
  SUM(final_amount) AS total_amount, COUNT(final_amount) AS n FROM ads2_o GROUP BY order_date)""", """
ads2_buyers AS (SELECT DISTINCT user_id, order_date AS stat_date FROM ads2_o)""", """
ads2_active AS (SELECT stat_date, COUNT(*) AS active_users FROM ads2_buyers GROUP BY stat_date)""", """
ads2_new AS (SELECT first_d AS stat_date, COUNT(*) AS new_users FROM (
  SELECT user_id, MIN(stat_date) AS first_d FROM ads2_buyers GROUP BY user_id) GROUP BY first_d)""", """
ads2_ret AS (SELECT b.stat_date, COUNT(*) AS retained FROM ads2_buyers a
  JOIN ads2_buyers b ON a.user_id = b.user_id AND a.stat_date + 1 = b.stat_date GROUP BY b.stat_date)""", """
ads2_prev AS (SELECT d.stat_date + 1 AS stat_date, a.active_users AS prev_users, d.total_amount AS prev_amount
  FROM ads2_daily d JOIN ads2_active a ON d.stat_date = a.stat_date)"""])


# ---------------------------------------------------------------- tier C
def _dim_product_cte() -> str:
    return f"""
dim_product AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
    {_category_case('p_name')} AS category_id,
    p_brand AS brand, p_type AS product_type, p_size AS size,
    CAST(p_retailprice AS DECIMAL(10,2)) AS list_price
  FROM part)"""


PRODUCT_CATEGORY_SALES = """
SELECT COALESCE(d.category_id, 'OTHER') AS category_id, COUNT(o.order_id) AS order_lines,
  CAST(SUM(o.final_amount) AS DECIMAL(20,2)) AS total_amount, COUNT(DISTINCT o.product_id) AS products
FROM dwd_order_info o LEFT JOIN dim_product d ON o.product_id = d.product_id
GROUP BY COALESCE(d.category_id, 'OTHER')"""

DQ_RECONCILIATION = """
, faults AS (
  SELECT dt, order_id, product_id, final_amount, order_status,
         CASE WHEN substr(dt, 6, 2) = '03' THEN CAST(order_id AS BIGINT) % 97 ELSE -1 END AS place
  FROM dwd_order_info
), a AS (
  SELECT dt, order_id, COUNT(*) AS n, list_sort(list({'p': product_id, 'f': final_amount, 's': order_status})) AS held
  FROM faults GROUP BY ALL
), b AS (
  SELECT dt, CASE WHEN place = 13 THEN 'x' || order_id ELSE order_id END AS order_id, COUNT(*) AS n,
         list_sort(list({'p': product_id, 'f': final_amount, 's': CASE WHEN place = 11 THEN NULL ELSE order_status END})) AS held
  FROM faults WHERE place <> 7 GROUP BY ALL
)
SELECT coalesce(a.dt, b.dt) AS dt, coalesce(a.order_id, b.order_id) AS order_id,
       CASE WHEN b.n IS NULL THEN 'lost' WHEN a.n IS NULL THEN 'invented' ELSE 'changed' END AS status,
       CAST(coalesce(a.n, 0) AS BIGINT) AS source_rows, CAST(coalesce(b.n, 0) AS BIGINT) AS target_rows
FROM a FULL OUTER JOIN b ON a.dt = b.dt AND a.order_id = b.order_id
WHERE a.n IS NULL OR b.n IS NULL OR a.held IS DISTINCT FROM b.held"""

def _encrypted_users(key: bytes) -> str:
    inner, outer = (bytes(b ^ x for b in key.ljust(64, b"\0")).hex() for x in (0x36, 0x5C))
    return f"""
SELECT user_id, email, phone,
       CASE WHEN email IS NOT NULL THEN CASE WHEN CAST(user_id AS BIGINT) % 2 = 0 THEN 'k2' ELSE 'k1' END END AS email_key,
       sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode(email)))) AS email_digest
FROM dwd_user_info"""


USER_HISTORY = ["""
user_versions AS (
  SELECT user_id, CASE WHEN i >= 3 THEN username || '@new.example.com' ELSE email END AS email,
         CASE WHEN i >= 2 THEN 'suspended' ELSE status END AS status,
         CAST(update_time AS TIMESTAMP) + to_days(CAST(200 * i AS INTEGER)) AS update_time
  FROM (SELECT *, unnest(range(0, CAST(regexp_extract(username, '#(.*)$', 1) AS BIGINT) % 4 + 1)) AS i FROM ods_user_info)
  WHERE user_id IS NOT NULL
)""", """
user_changes AS (
  SELECT * FROM (
    SELECT *, row_number() OVER w AS place, lag(email) OVER w AS email_before, lag(status) OVER w AS status_before
    FROM user_versions WINDOW w AS (PARTITION BY user_id ORDER BY update_time))
  WHERE place = 1 OR email IS DISTINCT FROM email_before OR status IS DISTINCT FROM status_before
)""", """
user_history AS (
  SELECT user_id, email, status, update_time AS valid_from,
         lead(update_time) OVER (PARTITION BY user_id ORDER BY update_time) AS valid_to
  FROM user_changes
)"""]
DIM_USER_HISTORY = "SELECT *, valid_to IS NULL AS is_current FROM user_history"
ORDERS_WITH_USER_AS_OF = """
SELECT o.order_id, o.user_id, o.product_id, o.final_amount, o.create_time,
       h.email AS email_as_of, h.status AS status_as_of, h.valid_from AS version_from
FROM dwd_order_info o ASOF LEFT JOIN user_history h ON o.user_id = h.user_id AND o.create_time >= h.valid_from"""

DIM_USER = """
SELECT user_id, username, email, phone, register_date, last_login_date, status, is_active, user_level,
  create_time, update_time, dt
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY update_time DESC NULLS LAST,
    create_time DESC NULLS LAST, dt DESC NULLS LAST, username DESC NULLS LAST, email DESC NULLS LAST,
    phone DESC NULLS LAST, register_date DESC NULLS LAST, last_login_date DESC NULLS LAST,
    status DESC NULLS LAST, is_active DESC NULLS LAST, user_level DESC NULLS LAST) AS rn
  FROM dwd_user_info
) WHERE rn = 1"""

GEO_ROLLUP = """
SELECT p.region, p.nation, COUNT(p.order_id) AS order_lines,
  CAST(SUM(p.final_amount) AS DECIMAL(20,2)) AS total_amount,
  COUNT(DISTINCT p.user_id) AS buyers,
  CAST(GROUPING(p.region, p.nation) AS BIGINT) AS grouping_level
FROM (SELECT o.order_id, o.user_id, o.final_amount, COALESCE(g.region, 'UNKNOWN') AS region,
        COALESCE(g.nation, 'UNKNOWN') AS nation
      FROM dwd_order_info o LEFT JOIN (
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, r_name AS region, n_name AS nation
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      ) g ON o.user_id = g.user_id) p
GROUP BY ROLLUP (p.region, p.nation)"""

DWD_BY_DIMENSION = """
SELECT o.* REPLACE (COALESCE(d.category_id, 'OTHER') AS category_id)
FROM dwd_order_info o LEFT JOIN dim_product d ON o.product_id = d.product_id"""

ORDERS_BY_REGION = """
SELECT strftime(o.order_date, '%Y-%m') AS month, COALESCE(g.region, 'UNKNOWN') AS region,
  COUNT(*) AS order_lines, CAST(SUM(o.final_amount) AS DECIMAL(20,2)) AS total_amount
FROM dwd_order_info o LEFT JOIN (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
) g ON o.user_id = g.user_id
GROUP BY strftime(o.order_date, '%Y-%m'), COALESCE(g.region, 'UNKNOWN')"""

FACT_USER_BEHAVIOR = """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, ts AS event_ts,
  CAST(ts AS DATE) AS event_date, value,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS prop_k,
  strftime(ts, '%Y-%m-%d') AS dt
FROM events"""

EVENT_PROPERTIES = """
SELECT event_type, property, kind, COUNT(*) AS occurrences,
       MIN(CASE WHEN kind = 'number' THEN TRY_CAST(held AS DOUBLE) END) AS least,
       MAX(CASE WHEN kind = 'number' THEN TRY_CAST(held AS DOUBLE) END) AS greatest
FROM (
  SELECT event_type, property, json_extract_string(props, '$."' || property || '"') AS held,
         CASE json_type(props, '$."' || property || '"') WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'truth'
              WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind
  FROM (SELECT event_type, props, unnest(json_keys(props)) AS property FROM events WHERE json_valid(props)))
GROUP BY ALL"""

MASKED_USERS = """
SELECT user_id, username, sha256('{salt}' || email) AS email_sha256,
  CASE WHEN length(phone) > 4 THEN repeat('*', length(phone) - 4) || right(phone, 4)
       ELSE repeat('*', length(phone)) END AS phone_masked,
  status, is_active, user_level, dt
FROM dwd_user_info"""


STREAM_DEDUP_INGEST = "SELECT event_id, user_id, event_type, value, props, ts FROM events"

STREAM_USER_DAILY = """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
  CAST(user_id AS VARCHAR) AS user_id, COUNT(*) AS event_count,
  CAST(COUNT_IF(event_type = 'view') AS BIGINT) AS view_count,
  CAST(COUNT_IF(event_type = 'purchase') AS BIGINT) AS purchase_count,
  CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total_value
FROM events
GROUP BY date_trunc('day', ts), CAST(user_id AS VARCHAR)"""

STREAM_ODS_LANDING = """
SELECT strftime(ts, '%Y-%m-%d') AS dt, COUNT(*) AS orders, COUNT(DISTINCT event_id) AS order_ids,
  CAST(SUM(CAST(value AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total_amount
FROM events WHERE event_type = 'purchase'
GROUP BY strftime(ts, '%Y-%m-%d')"""

EVENT_LOG_DAILY = """
SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type, COUNT(*) AS events, COUNT(DISTINCT user_id) AS users,
  CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total_value
FROM events
GROUP BY strftime(ts, '%Y-%m-%d'), event_type"""


_BY_PERIOD = """
SELECT '{p}' AS period, CAST(date_trunc('{p}', CAST(dt AS DATE)) AS DATE) AS period_start, '{level}' AS level,
       {value} AS category_id, COUNT(DISTINCT user_id) AS active_users
FROM dwd_order_info GROUP BY ALL"""
ACTIVE_USERS_BY_PERIOD = " UNION ALL ".join(
    _BY_PERIOD.format(p=p, level=level, value=value) for p in ("week", "month")
    for level, value in (("category_id", "category_id"), ("all", "CAST(NULL AS VARCHAR)")))

ACTIVE_USERS_TRAILING = """
SELECT d.dt, COUNT(DISTINCT o.user_id) AS active_users
FROM (SELECT DISTINCT dt FROM dwd_order_info) d
JOIN (SELECT DISTINCT dt, user_id FROM dwd_order_info) o
  ON CAST(o.dt AS DATE) BETWEEN CAST(d.dt AS DATE) - 6 AND CAST(d.dt AS DATE)
GROUP BY d.dt"""


def oracle_sql() -> dict[str, str]:
    from laminar.plans import registry as r
    out = _base_sql()
    out.update(dq_sql(r.DQ_AS_OF, r.DQ_MIN_DATE))
    out["dq_findings_persisted"] = out["dq_findings"]       # the written table holds the same rows
    out["etl_roundtrip"] = LAYER_ROW_COUNTS
    out["login_count"] = LOGIN_COUNT
    out["dim_date"] = _dim_date_sql()
    out["ads_user_behavior"] = _ads_user_behavior_sql(r.ADS_AS_OF, r.ADS_BAD_STATUSES, r.ADS_RUN_TS)
    out["ads_sales_trend"] = _ads_sales_trend_sql(r.TREND_RUN_TS)
    out["ads_user_behavior_incremental"] = out["ads_user_behavior"]
    out["ads_sales_trend_incremental"] = out["ads_sales_trend"]
    out["ads_sales_trend_written"] = (
        "SELECT stat_date, total_orders, total_amount, new_users, active_users, retention_rate, growth_rate, year, month "
        f"FROM ({out['ads_sales_trend']})")
    out["active_users_by_period"] = with_layers(ACTIVE_USERS_BY_PERIOD)
    out["active_users_trailing"] = with_layers(ACTIVE_USERS_TRAILING)
    out["dim_product"] = "WITH " + _dim_product_cte() + "\nSELECT * FROM dim_product"
    out["product_category_sales"] = with_layers(PRODUCT_CATEGORY_SALES, [_dim_product_cte()])
    out["dwd_order_info_by_dimension"] = with_layers(DWD_BY_DIMENSION, [_dim_product_cte()])
    out["dwd_order_info_by_lookup_table"] = out["dwd_order_info_by_dimension"]
    out["orders_by_region_orc"] = with_layers(ORDERS_BY_REGION)
    out["dq_reconciliation"] = with_layers(DQ_RECONCILIATION)
    out["encrypted_users"] = with_layers(_encrypted_users(r.TEST_KEYS["k1"]))
    out["dim_user"] = with_layers(DIM_USER)
    out["dim_user_history"] = with_layers(DIM_USER_HISTORY, USER_HISTORY)
    out["orders_with_user_as_of"] = with_layers(ORDERS_WITH_USER_AS_OF, USER_HISTORY)
    out["geo_rollup"] = with_layers(GEO_ROLLUP)
    out["fact_user_behavior"] = FACT_USER_BEHAVIOR
    out["event_properties"] = EVENT_PROPERTIES
    out["masked_users"] = with_layers(MASKED_USERS.replace("{salt}", r.TEST_SALT))
    out["stream_dedup_ingest"] = STREAM_DEDUP_INGEST
    out["stream_user_daily"] = STREAM_USER_DAILY
    out["stream_user_daily_bounded"] = STREAM_USER_DAILY
    out["stream_ods_landing"] = STREAM_ODS_LANDING
    out["event_log_daily"] = EVENT_LOG_DAILY
    return out
