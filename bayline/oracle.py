"""DuckDB texts, one per query with a SQL counterpart, over the supplied tables.

They are written independently of the Spark plans (global row numbers, windows, plain joins) and
serve only to check results at small scale.
"""

from __future__ import annotations

from bayline.queries import (
    BUCKET_END, BUCKET_START, BUCKET_STEP, HISTORY_CHANGE, HISTORY_CUTOFF, HISTORY_MONTHS,
    HISTORY_OPEN, LOAD_DATES, SCAN_DEALER, SCAN_MONTH, TABLE_MONTHS,
)
from bayline.schemas import FEATURES, HISTORY_CSV, SERVICE_TYPES
from bayline.sources.event_feed import FEED_TYPES
from bayline.sources.service_tables import AS_OF

ORACLE: dict[str, str] = {}


def half_up(num: str, den: str, digits: int) -> str:
    """num / den rounded half up, in integer arithmetic (both non-negative integers)."""
    scale = 10 ** digits
    return (
        f"CASE WHEN {den} = 0 THEN NULL ELSE CAST((CAST({num} AS HUGEINT) * {2 * scale} + {den})"
        f" // (2 * ({den})) AS DOUBLE) / {scale} END"
    )


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


ORDINAL = (
    "row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,"
    " l_quantity, l_extendedprice)"
)

RAW = f"""
lines AS (
  SELECT *, {ORDINAL} AS ordinal, concat('RO', l_orderkey, '-', l_linenumber) AS ro_number,
         CAST(1 + l_quantity % 5 AS INTEGER) AS survey_score
  FROM lineitem),
raw_ro AS (
  SELECT l.ro_number, l.ordinal, l_suppkey AS dealer_key, CAST(l_suppkey AS VARCHAR) AS dealer_id,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_partkey END AS vehicle_key,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'recall' WHEN '2-HIGH' THEN 'warranty_repair'
      WHEN '3-MEDIUM' THEN 'scheduled_maintenance'
      WHEN '4-NOT SPECIFIED' THEN 'customer_pay_repair'
      ELSE CASE WHEN l_partkey % 89 = 0 THEN 'unknown' ELSE 'diagnostic' END END AS service_type,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'warranty' ELSE 'customer' END
      AS pay_type,
    CAST(l_shipdate AS DATE) AS service_date,
    CAST(CASE l_linenumber % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 5 ELSE 8 END
      AS INTEGER) AS days_to_close,
    CAST(CASE WHEN l_quantity = 50 THEN -l_extendedprice ELSE l_extendedprice END
      AS DECIMAL(18,2)) AS labor_amount,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2))
      AS parts_amount,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS repeat_repair_flag,
    o_custkey AS customer_key
  FROM lines l JOIN orders ON o_orderkey = l_orderkey),
tested AS (
  SELECT *, vehicle_key IS NULL AS no_vin, (labor_amount < 0 OR parts_amount < 0) AS negative,
    service_type NOT IN ({quoted(SERVICE_TYPES)}) AS bad_type
  FROM raw_ro),
gated AS (
  SELECT *, coalesce(min(CASE WHEN NOT (no_vin OR negative OR bad_type) THEN ordinal END)
      OVER (PARTITION BY ro_number) < ordinal, FALSE) AS repeated
  FROM tested),
reasoned AS (
  SELECT *, concat_ws(',', CASE WHEN no_vin THEN 'missing_vin' END,
      CASE WHEN negative THEN 'negative_amount' END,
      CASE WHEN repeated THEN 'duplicate_ro_number' END,
      CASE WHEN bad_type THEN 'invalid_service_type' END) AS reason
  FROM gated),
clean AS (SELECT * FROM reasoned WHERE reason = ''),
"""

FACT = RAW + """
survey AS (
  SELECT ro_number, arg_max(survey_score, ordinal) AS satisfaction_score,
    CASE WHEN arg_max(survey_score, ordinal) >= 4 THEN 1 ELSE 0 END AS would_recommend
  FROM lines WHERE l_orderkey % 3 = 0 GROUP BY ro_number),
fact AS (
  SELECT c.*, c.labor_amount + c.parts_amount AS total_amount,
    CAST((c.labor_amount + c.parts_amount) * 100 AS BIGINT) AS cents,
    CAST(date_trunc('month', service_date) AS DATE) AS service_month,
    CAST(strftime(service_date, '%Y%m%d') AS INTEGER) AS open_date_key,
    s.satisfaction_score, s.would_recommend
  FROM clean c LEFT JOIN survey s USING (ro_number)),
dealer AS (
  SELECT s_suppkey AS dealer_key, CAST(s_suppkey AS VARCHAR) AS dealer_id, s_name AS dealer_name,
    r_name AS region, CAST(4 + s_suppkey % 21 AS INTEGER) AS service_bays, s_nationkey
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
vehicle AS (
  SELECT p_partkey AS vehicle_key, CAST(p_partkey AS VARCHAR) AS vin, p_type AS model,
    CAST(1992 + p_size % 8 AS INTEGER) AS model_year,
    CASE p_size % 3 WHEN 2 THEN 60 ELSE 36 END AS warranty_months,
    make_date(1992 + p_size % 8, 1, 1) AS in_service_date
  FROM part),
cust AS (
  SELECT c_custkey AS customer_key,
    sha256(lower(trim(concat(c_name, '@example.test')))) AS email_hash,
    right(concat('555-', lpad(CAST(c_custkey AS VARCHAR), 7, '0')), 4) AS phone_last4,
    CASE WHEN c_acctbal < 0 THEN 'ccpa_opt_out' WHEN c_mktsegment = 'MACHINERY' THEN 'unknown'
      ELSE 'consented' END AS consent_status, c_nationkey
  FROM customer),
"""


def over(base: str, text: str) -> str:
    return "WITH " + base.strip().rstrip(",") + "\n" + text.strip()


def fact(name: str, text: str, more: str = "") -> None:
    ORACLE[name] = over(FACT + more, text)


def raw(name: str, text: str, more: str = "") -> None:
    ORACLE[name] = over(RAW + more, text)


# --- quality and audit -----------------------------------------------------------------------

raw("dq_clean_orders", f"""
SELECT ro_number, dealer_id, CAST(vehicle_key AS VARCHAR) AS vin, service_type,
  {day('service_date')} AS open_date, days_to_close, CAST(labor_amount AS DOUBLE) AS labor_amount,
  CAST(parts_amount AS DOUBLE) AS parts_amount, pay_type, repeat_repair_flag,
  customer_key AS customer_id
FROM clean""")

_TEXT_ROW = [
    ("ro_number", "ro_number"), ("dealer_id", "dealer_id"),
    ("vin", "CAST(vehicle_key AS VARCHAR)"), ("service_type", "service_type"),
    ("open_date", day("service_date")), ("days_to_close", "CAST(days_to_close AS VARCHAR)"),
    ("labor_amount", "CAST(labor_amount AS VARCHAR)"),
    ("parts_amount", "CAST(parts_amount AS VARCHAR)"), ("pay_type", "pay_type"),
    ("repeat_repair_flag", "CAST(repeat_repair_flag AS VARCHAR)"),
    ("customer_id", "CAST(customer_key AS VARCHAR)"),
]
_JSON = " || ',' || ".join(
    f"""'"{name}":' || coalesce('"' || {expr} || '"', 'null')""" for name, expr in _TEXT_ROW)

raw("dq_rejects", f"""
SELECT ro_number, reason, '{{' || {_JSON} || '}}' AS raw_row FROM reasoned WHERE reason <> ''""")

_AUDIT = """
audit AS (
  SELECT CAST(1 AS INTEGER) AS seq, 'extract' AS stage, 'orders' AS entity,
    (SELECT count(*) FROM raw_ro) AS row_count
  UNION ALL SELECT 2, 'extract', 'vehicles', (SELECT count(*) FROM part)
  UNION ALL SELECT 3, 'extract', 'dealers', (SELECT count(*) FROM supplier)
  UNION ALL SELECT 4, 'extract', 'surveys',
    (SELECT count(*) FROM lineitem WHERE l_orderkey % 3 = 0)
  UNION ALL SELECT 5, 'validate', 'orders_clean', (SELECT count(*) FROM clean)
  UNION ALL SELECT 6, 'validate', 'orders_rejected',
    (SELECT count(*) FROM reasoned WHERE reason <> '')
  UNION ALL SELECT 7, 'validate', 'orphans_rejected',
    (SELECT count(*) FROM clean WHERE dealer_key NOT IN (SELECT dealer_key FROM dealer)
      OR vehicle_key NOT IN (SELECT vehicle_key FROM vehicle))
  UNION ALL SELECT 8, 'load', 'fact_repair_orders', (SELECT count(*) FROM fact)),
"""
fact("etl_audit", "SELECT * FROM audit", _AUDIT)
raw("etl_run_stats", """
SELECT 'extracted' AS metric, '' AS reason, count(*) AS row_count FROM reasoned
UNION ALL SELECT 'loaded', '', count(*) FROM clean
UNION ALL SELECT 'rejected', '', count(*) FROM reasoned WHERE reason <> ''
UNION ALL SELECT 'reject_reason', reason, count(*) FROM reasoned WHERE reason <> '' GROUP BY reason
""")
fact("audit_balance", """
SELECT (SELECT row_count FROM audit WHERE seq = 1) AS extracted,
  (SELECT row_count FROM audit WHERE seq = 8) AS loaded,
  (SELECT row_count FROM audit WHERE seq = 6) AS rejected,
  (SELECT row_count FROM audit WHERE seq = 7) AS orphans,
  CAST((SELECT row_count FROM audit WHERE seq = 1) = (SELECT CAST(sum(row_count) AS BIGINT)
    FROM audit WHERE seq >= 6) AS INTEGER) AS balanced""", _AUDIT)

_EVENTS = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS ro_number, CAST(user_id AS INTEGER) AS dealer_key,
    CAST(ts AS DATE) AS service_date, event_type AS service_type,
    CAST(value AS DECIMAL(18,2)) AS total_amount,
    CAST(json_extract(props, '$.k') AS INTEGER) AS satisfaction_score
  FROM events),
"""


def _zero(name: str, n: str) -> str:
    return (f"SELECT '{name}' AS check_name, CAST({n} AS DOUBLE) AS measured,"
            f" CAST({n} = 0 AS INTEGER) AS passed")


_COVER = "(SELECT round(count(satisfaction_score) * 100.0 / count(*), 4) FROM fact)"
fact("dq_checks", "\nUNION ALL\n".join([
    _zero("measures_valid", "(SELECT count(*) FROM fact WHERE labor_amount < 0 OR parts_amount < 0"
          " OR total_amount IS NULL OR abs(total_amount - labor_amount - parts_amount) > 0.01)"),
    f"SELECT 'survey_coverage', CAST({_COVER} AS DOUBLE),"
    f" CAST({_COVER} BETWEEN 25 AND 45 AS INTEGER)",
    _zero("fact_grain_unique", "(SELECT count(*) FROM (SELECT ro_number FROM fact"
          " GROUP BY ro_number HAVING count(*) > 1))"),
    _zero("no_raw_email", "(SELECT count(*) FROM cust WHERE email_hash LIKE '%@%')"),
    _zero("phone_is_four_characters", "(SELECT count(*) FROM cust WHERE length(phone_last4) <> 4)"),
    _zero("customer_grain_unique", "(SELECT count(*) FROM (SELECT email_hash FROM cust"
          " GROUP BY email_hash HAVING count(*) > 1))"),
    _zero("rejects_have_reason",
          "(SELECT count(*) FROM reasoned WHERE reason = '' AND (no_vin OR negative OR repeated"
          " OR bad_type))"),
    *[_zero(f"staging_{c}_not_null", f"(SELECT count(*) FROM ev WHERE {c} IS NULL)")
      for c in ("ro_number", "service_date", "dealer_key")],
    _zero("staging_amount_not_negative", "(SELECT count(*) FROM ev WHERE total_amount < 0)"),
    _zero("staging_service_type_known",
          f"(SELECT count(*) FROM ev WHERE service_type NOT IN ({quoted(FEED_TYPES)}))"),
    _zero("staging_ro_number_unique", "(SELECT count(*) FROM (SELECT ro_number FROM ev"
          " GROUP BY ro_number HAVING count(*) > 1))"),
    _zero("mart_ro_count_positive", "(SELECT count(*) FROM (SELECT dealer_key, count(*) AS n"
          " FROM ev GROUP BY dealer_key, date_trunc('month', service_date)) WHERE n <= 0)"),
]), _EVENTS)

fact("orphan_fact_rows", """
SELECT 'dealer' AS dimension, count(*) AS orphan_rows FROM fact
  WHERE dealer_key NOT IN (SELECT dealer_key FROM dealer)
UNION ALL SELECT 'vehicle', count(*) FROM fact
  WHERE vehicle_key NOT IN (SELECT vehicle_key FROM vehicle)
UNION ALL SELECT 'date', count(*) FROM fact
  WHERE service_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""")
fact("orphan_fact_rows_stale_dims", """
SELECT 'dealer' AS dimension, CAST(dealer_key AS VARCHAR) AS missing_key, count(*) AS orphan_rows
FROM fact WHERE dealer_key % 10 = 0 GROUP BY dealer_key
UNION ALL SELECT 'vehicle', CAST(vehicle_key AS VARCHAR), count(*)
FROM fact WHERE vehicle_key % 50 = 0 GROUP BY vehicle_key
UNION ALL SELECT 'date', CAST(open_date_key AS VARCHAR), count(*) FROM fact
WHERE service_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders) GROUP BY open_date_key""")

_VERSIONS = """
old AS (
  SELECT o_orderkey, o_custkey, o_orderpriority,
    CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders),
new1 AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 20 = 3 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
    CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
  FROM old WHERE o_orderkey % 50 <> 7),
new2 AS (
  SELECT * FROM new1 UNION ALL SELECT * FROM new1 WHERE o_orderkey % 100 = 1),
"""
_DIFFERS = """(SELECT count(*) FROM old JOIN new1 USING (o_orderkey)
  WHERE o_orderkey % 100 <> 1 AND old.{0} IS DISTINCT FROM new1.{0})"""
ORACLE["reconcile_datasets"] = over(_VERSIONS, """
SELECT 'rows' AS measure, '*' AS column_name, CAST((SELECT count(*) FROM old) AS DOUBLE)
  AS old_value, CAST((SELECT count(*) FROM new2) AS DOUBLE) AS new_value
UNION ALL SELECT 'sum', 'o_totalprice', CAST((SELECT sum(o_totalprice) FROM old) AS DOUBLE),
  CAST((SELECT sum(o_totalprice) FROM new2) AS DOUBLE)
UNION ALL SELECT 'keys_on_one_side', 'o_orderkey',
  CAST((SELECT count(*) FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new1))
    AS DOUBLE), 0.0
UNION ALL SELECT 'repeated_keys', 'o_orderkey',
  CAST((SELECT count(*) FROM new1 WHERE o_orderkey % 100 = 1) AS DOUBLE), 0.0
""" + "\n".join(
    f"UNION ALL SELECT 'differing_fields', '{c}', CAST({_DIFFERS.format(c)} AS DOUBLE), 0.0"
    for c in ("o_custkey", "o_orderpriority", "o_totalprice")))
ORACLE["reconcile_differing_rows"] = over(_VERSIONS, """
SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
  'old' AS side FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new2)
UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_totalprice AS DOUBLE), 'new'
FROM (SELECT * FROM new2 EXCEPT ALL SELECT * FROM old)""")

ORACLE["narrowed_difference"] = ORACLE["reconcile_differing_rows"]
ORACLE["profile_by_part"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,"
    f" CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM orders"
    for c in ("o_orderpriority", "o_custkey"))

ORACLE["profile_table"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS column_name, count(*) AS row_count,"
    f" count(*) - count({expr}) AS null_count, CAST(min({expr}) AS VARCHAR) AS min_value,"
    f" CAST(max({expr}) AS VARCHAR) AS max_value, count(DISTINCT {expr}) AS distinct_count"
    f" FROM orders"
    for name, expr in [
        ("o_orderkey", "o_orderkey"), ("o_custkey", "o_custkey"),
        ("o_orderstatus", "o_orderstatus"), ("o_orderpriority", "o_orderpriority"),
        ("o_totalprice", "CAST(o_totalprice AS DECIMAL(18,2))"),
        ("o_orderdate", "CAST(o_orderdate AS DATE)"),
    ])

# --- dimensions and fact ---------------------------------------------------------------------

fact("dim_dealer", """
SELECT row_number() OVER (ORDER BY dealer_key) AS dealer_key, dealer_id, dealer_name, region,
  service_bays FROM dealer""")
fact("dim_vehicle", f"""
SELECT row_number() OVER (ORDER BY vehicle_key) AS vehicle_key, vin, model, model_year,
  warranty_months, {day('in_service_date')} AS in_service_date FROM vehicle""")
_NUMBERED = """
first_seen AS (
  SELECT customer_key, min(ordinal) AS seen FROM clean GROUP BY customer_key),
numbered AS (
  SELECT row_number() OVER (ORDER BY seen) AS number, customer_key FROM first_seen),
dealer_no AS (
  SELECT row_number() OVER (ORDER BY dealer_key) AS number, dealer_key FROM dealer),
vehicle_no AS (
  SELECT row_number() OVER (ORDER BY vehicle_key) AS number, vehicle_key FROM vehicle),
"""
fact("dim_customer", """
SELECT number AS customer_key, email_hash, phone_last4, 'consented' AS consent_status
FROM numbered JOIN cust USING (customer_key)""", _NUMBERED)
fact("dim_date", f"""
SELECT DISTINCT open_date_key AS date_key, {day('service_date')} AS full_date,
  CAST(year(service_date) AS INTEGER) AS year, CAST(quarter(service_date) AS INTEGER) AS quarter,
  CAST(month(service_date) AS INTEGER) AS month, monthname(service_date) AS month_name,
  CASE WHEN isodow(service_date) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM fact""")
fact("fact_repair_orders", f"""
SELECT row_number() OVER (ORDER BY ordinal) AS ro_key, ro_number, d.number AS dealer_key,
  v.number AS vehicle_key, n.number AS customer_key, open_date_key,
  {day('service_date')} AS service_date, {day('service_month')} AS service_month,
  service_type, pay_type, days_to_close, CAST(labor_amount AS DOUBLE) AS labor_amount,
  CAST(parts_amount AS DOUBLE) AS parts_amount, CAST(total_amount AS DOUBLE) AS total_amount,
  repeat_repair_flag, satisfaction_score, would_recommend
FROM fact f JOIN numbered n ON n.customer_key = f.customer_key
JOIN dealer_no d ON d.dealer_key = f.dealer_key
JOIN vehicle_no v ON v.vehicle_key = f.vehicle_key""", _NUMBERED)
ORACLE["warehouse_from_files"] = ORACLE["fact_repair_orders"]
# Loads by date; within a load the rows keep their order, and earlier loads come first.
_LOADS = RAW.replace("tested AS (\n  SELECT *,", f"""tested AS (
  SELECT *, CAST(CASE WHEN service_date < DATE '{LOAD_DATES[0]}' THEN 1 WHEN service_date < DATE '{LOAD_DATES[1]}' THEN 2
    ELSE 3 END AS INTEGER) AS load,""").replace(
    "min(CASE WHEN NOT (no_vin OR negative OR bad_type) THEN ordinal END)",
    "min(CASE WHEN NOT (no_vin OR negative OR bad_type) THEN load * 1000000000000 + ordinal END)").replace(
    "OVER (PARTITION BY ro_number) < ordinal", "OVER (PARTITION BY ro_number) < load * 1000000000000 + ordinal") + """
survey AS (
  SELECT ro_number, arg_max(survey_score, ordinal) AS satisfaction_score FROM lines
  WHERE l_orderkey % 3 = 0 GROUP BY ro_number),
cust AS (
  SELECT c_custkey AS customer_key, sha256(lower(trim(concat(c_name, '@example.test')))) AS email_hash FROM customer),
delivered AS (
  SELECT 'dealer' AS dimension, CAST(s_suppkey AS VARCHAR) AS natural_key, s_suppkey AS first_row,
    CAST(1 + s_suppkey % 3 AS INTEGER) AS load FROM supplier
  UNION ALL SELECT 'vehicle', CAST(p_partkey AS VARCHAR), p_partkey, CAST(1 + p_partkey % 3 AS INTEGER) FROM part
  UNION ALL SELECT 'customer', email_hash, min(ordinal - 1000000000000 * (3 - load)), min(load)
  FROM clean JOIN cust USING (customer_key) GROUP BY email_hash),
keys AS (
  SELECT dimension, natural_key, load,
    row_number() OVER (PARTITION BY dimension ORDER BY load, first_row) AS surrogate_key FROM delivered),
found AS (
  SELECT c.*, s.satisfaction_score, n.surrogate_key AS customer_no,
    CASE WHEN d.load <= c.load THEN d.surrogate_key END AS dealer_no,
    CASE WHEN v.load <= c.load THEN v.surrogate_key END AS vehicle_no
  FROM clean c JOIN cust USING (customer_key)
  JOIN keys n ON n.dimension = 'customer' AND n.natural_key = email_hash
  LEFT JOIN keys d ON d.dimension = 'dealer' AND d.natural_key = c.dealer_id
  LEFT JOIN keys v ON v.dimension = 'vehicle' AND v.natural_key = CAST(c.vehicle_key AS VARCHAR)
  LEFT JOIN survey s USING (ro_number)),
"""
ORACLE["keys_over_loads"] = over(_LOADS, "SELECT dimension, natural_key, surrogate_key, load FROM keys")
ORACLE["fact_over_loads"] = over(_LOADS, f"""
SELECT row_number() OVER (ORDER BY load, ordinal) AS ro_key, load, ro_number, dealer_no AS dealer_key,
  vehicle_no AS vehicle_key, customer_no AS customer_key,
  CAST(strftime(service_date, '%Y%m%d') AS INTEGER) AS open_date_key, {day('service_date')} AS service_date,
  {day("date_trunc('month', service_date)")} AS service_month, service_type, pay_type, days_to_close,
  CAST(labor_amount AS DOUBLE) AS labor_amount, CAST(parts_amount AS DOUBLE) AS parts_amount,
  CAST(labor_amount + parts_amount AS DOUBLE) AS total_amount, repeat_repair_flag, satisfaction_score,
  CAST(satisfaction_score >= 4 AS INTEGER) AS would_recommend
FROM found WHERE dealer_no IS NOT NULL AND vehicle_no IS NOT NULL""")
ORACLE["rejects_over_loads"] = over(_LOADS, """
SELECT ro_number, reason, load FROM reasoned WHERE reason <> ''
UNION ALL
SELECT ro_number, concat_ws(',', CASE WHEN dealer_no IS NULL THEN 'orphan_dealer' END,
  CASE WHEN vehicle_no IS NULL THEN 'orphan_vehicle' END), load
FROM found WHERE dealer_no IS NULL OR vehicle_no IS NULL""")
fact("raw_landing", """
SELECT 'dealers' AS extract, dealer_id, dealer_name, CAST(1 AS INTEGER) AS from_file, CAST(1 AS INTEGER) AS has_time FROM dealer
UNION ALL SELECT 'dealers_asia', dealer_id, dealer_name, 1, 1 FROM dealer WHERE region = 'ASIA'""")
fact("published_refresh", """
SELECT region, pay_type, count(*) AS ro_count, CAST(sum(total_amount) AS DOUBLE) AS total_amount
FROM fact JOIN dealer USING (dealer_key) WHERE service_type = 'recall' GROUP BY region, pay_type""")
fact("curated_table", f"""
SELECT {day('service_month')} AS service_month, service_type, count(*) AS ro_count,
  CAST(sum(total_amount) AS DOUBLE) AS total_amount
FROM fact WHERE service_month BETWEEN DATE '{TABLE_MONTHS[0]}' AND DATE '{TABLE_MONTHS[1]}'
GROUP BY service_month, service_type""")
raw("survey_flatten", """
SELECT concat('SV-', ro_number, '-', l_partkey) AS survey_id, ro_number,
  CASE WHEN l_linestatus = 'O' THEN 'email' ELSE 'sms' END AS channel,
  survey_score AS satisfaction_score, CASE WHEN survey_score >= 4 THEN 1 ELSE 0 END
  AS would_recommend, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS comments_present
FROM lines WHERE l_orderkey % 3 = 0""")
fact("fact_survey_left_join", "SELECT ro_number, satisfaction_score, would_recommend FROM fact")
ORACLE["staging_service_events"] = over(_EVENTS, f"""
SELECT ro_number, dealer_key, {day('service_date')} AS service_date, service_type,
  CAST(total_amount AS DOUBLE) AS total_amount, satisfaction_score
FROM ev WHERE total_amount >= 0""")
_CURATED = f"""
SELECT ro_number, dealer_key, {day('service_date')} AS service_date,
  {day('service_month')} AS service_month, service_type,
  CAST(total_amount AS DOUBLE) AS total_amount, satisfaction_score FROM fact"""
fact("curated_fact", _CURATED)

# --- KPIs ------------------------------------------------------------------------------------

_FIXED = "count(*) FILTER (repeat_repair_flag = 0)"
_RECALL = "count(*) FILTER (service_type = 'recall')"
_PAID = "sum(CASE WHEN pay_type = '{0}' THEN {1} ELSE 0 END)"
_FFV = f"""SELECT region, {half_up(f'100 * {_FIXED}', 'count(*)', 1)} AS fixed_first_visit_pct,
  count(*) AS repair_orders FROM fact JOIN dealer USING (dealer_key) GROUP BY region"""
_CYCLE = f"""SELECT days_to_close, {half_up('sum(satisfaction_score)', 'count(*)', 2)} AS avg_csat,
  count(*) AS surveyed_ros FROM fact WHERE satisfaction_score IS NOT NULL GROUP BY days_to_close"""
_SHARE = f"""SELECT model, {_RECALL} AS recall_ros, count(*) AS total_ros,
  {half_up(f'100 * {_RECALL}', 'count(*)', 1)} AS recall_share_pct
  FROM fact JOIN vehicle USING (vehicle_key) GROUP BY model"""
_HEAD = f"""SELECT count(*) AS repair_orders,
  {half_up(f'100 * {_FIXED}', 'count(*)', 1)} AS fixed_first_visit_pct,
  {half_up('sum(satisfaction_score)', 'count(satisfaction_score)', 2)} AS avg_csat,
  {half_up(_PAID.format('customer', 'cents'), '100000000', 1)} AS customer_pay_revenue_m
  FROM fact"""
_MONTH = "CAST(year(service_date) AS INTEGER) AS year, CAST(month(service_date) AS INTEGER) AS month"

fact("kpi_fixed_first_visit", _FFV)
fact("kpi_dealer_csat_top10", f"""
SELECT dealer_name, region, {half_up('sum(satisfaction_score)', 'count(*)', 2)} AS avg_csat,
  {half_up('sum(cents)', '(100 * count(*))', 2)} AS avg_revenue_per_ro, count(*) AS ro_count
FROM fact JOIN dealer USING (dealer_key) WHERE satisfaction_score IS NOT NULL
GROUP BY dealer_key, dealer_name, region HAVING count(*) >= 50
ORDER BY avg_csat DESC, avg_revenue_per_ro DESC, dealer_name LIMIT 10""")
fact("kpi_pay_mix_by_month", f"""
SELECT {_MONTH}, monthname(service_date) AS month_name,
  CAST({_PAID.format('warranty', 'total_amount')} AS DOUBLE) AS warranty_spend,
  CAST({_PAID.format('customer', 'total_amount')} AS DOUBLE) AS customer_pay_revenue
FROM fact GROUP BY ALL""")
fact("kpi_throughput_per_bay", f"""
SELECT dealer_name, service_bays, count(*) AS annual_ros,
  {half_up('count(*)', 'service_bays', 1)} AS ros_per_bay
FROM fact JOIN dealer USING (dealer_key) GROUP BY dealer_key, dealer_name, service_bays
ORDER BY ros_per_bay DESC, dealer_name LIMIT 10""")
fact("kpi_csat_by_cycle_time", _CYCLE)
fact("kpi_recall_share", _SHARE)
fact("kpi_headline", _HEAD)

_TILES = f"""
head AS ({_HEAD}), ffv AS ({_FFV}), cycle AS ({_CYCLE}), recall AS ({_SHARE}),
mix AS (
  SELECT {_MONTH}, monthname(service_date) AS month_name,
    {half_up(_PAID.format('warranty', 'cents'), '100000', 1)} AS warranty,
    {half_up(_PAID.format('customer', 'cents'), '100000', 1)} AS customer
  FROM fact GROUP BY ALL),
tiles AS (
  SELECT 'headline' AS tile, 1 AS ord, 'repair_orders' AS label, 'headline' AS series,
    CAST(repair_orders AS DOUBLE) AS value, 2 AS digits FROM head
  UNION ALL SELECT 'headline', 2, 'fixed_first_visit_pct', 'headline', fixed_first_visit_pct, 2
    FROM head
  UNION ALL SELECT 'headline', 3, 'avg_csat', 'headline', avg_csat, 2 FROM head
  UNION ALL SELECT 'headline', 4, 'customer_pay_revenue_m', 'headline', customer_pay_revenue_m, 2
    FROM head
  UNION ALL SELECT 'region', row_number() OVER (ORDER BY fixed_first_visit_pct DESC, region),
    region, 'fixed_first_visit_pct', fixed_first_visit_pct, 1 FROM ffv
  UNION ALL SELECT 'cycle', row_number() OVER (ORDER BY days_to_close),
    CAST(days_to_close AS VARCHAR), 'avg_csat', avg_csat, 2 FROM cycle
  UNION ALL SELECT 'mix', row_number() OVER (ORDER BY year, month), month_name, 'warranty',
    warranty, 1 FROM mix
  UNION ALL SELECT 'mix', row_number() OVER (ORDER BY year, month), month_name, 'customer',
    customer, 1 FROM mix
  UNION ALL SELECT 'recall', row_number() OVER (ORDER BY recall_share_pct DESC, model), model,
    'recall_share_pct', recall_share_pct, 1 FROM recall),
"""
fact("dashboard_tiles", """
SELECT tile, CAST(ord AS BIGINT) AS ord, label, series, value,
  CASE digits WHEN 1 THEN format('{:,.1f}', value) ELSE format('{:,.2f}', value) END AS display
FROM tiles""", _TILES)

# --- marts and layout ------------------------------------------------------------------------


def _mart(digits: int) -> str:
    return f"""
mart AS (
  SELECT {day('service_month')} AS month, dealer_key, count(*) AS ro_count,
    CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
    {half_up('sum(satisfaction_score)', 'count(satisfaction_score)', digits)} AS avg_csat
  FROM fact GROUP BY service_month, dealer_key),
"""


fact("mart_monthly_dealer_revenue", "SELECT * FROM mart", _mart(2))
fact("mart_layout_roundtrip", "SELECT * FROM mart", _mart(6))
fact("mart_top3", "SELECT * FROM mart ORDER BY total_revenue DESC, month, dealer_key LIMIT 3",
     _mart(2))
fact("v_dealer_performance", f"""
SELECT {day('service_date')} AS service_date, dealer_key, service_type, pay_type,
  CAST(total_amount AS DOUBLE) AS total_amount, satisfaction_score FROM fact""")
fact("layout_roundtrip",
     _CURATED + " WHERE service_month BETWEEN DATE '1996-01-01' AND DATE '2000-12-01'")
fact("range_bucket_counts", f"""
SELECT CAST((open_date_key - {BUCKET_START}) // {BUCKET_STEP} AS BIGINT) AS bucket,
  count(*) AS ro_count, CAST(sum(total_amount) AS DOUBLE) AS total_amount
FROM fact WHERE open_date_key < {BUCKET_END} GROUP BY 1""")
_HIT = f"service_month = DATE '{SCAN_MONTH}' AND dealer_key = {SCAN_DEALER}"
# The state that the corrections lead to, counted anew.
fact("mart_after_corrections", f"""
SELECT {day("date_trunc('month', moved)")} AS month, dealer_key, count(*) AS ro_count,
  CAST(sum(amount) AS DOUBLE) AS total_revenue, CAST(coalesce(sum(satisfaction_score), 0) AS BIGINT) AS score_sum,
  count(satisfaction_score) AS score_count
FROM (SELECT *, CASE WHEN (dealer_key * 7 + day(service_date)) % 10 = 0
    THEN service_date + INTERVAL 1 MONTH ELSE service_date END AS moved,
    CASE WHEN day(CASE WHEN (dealer_key * 7 + day(service_date)) % 10 = 0
      THEN service_date + INTERVAL 1 MONTH ELSE service_date END) = 3 THEN total_amount + 1 ELSE total_amount END AS amount
  FROM fact WHERE customer_key % 10 <> 0)
GROUP BY 1, 2""")
fact("pruned_scan", f"""
SELECT ro_number, dealer_key, {day('service_date')} AS service_date, service_type,
  CAST(total_amount AS DOUBLE) AS total_amount FROM fact WHERE {_HIT}""")
fact("pruning_benefit", f"""
SELECT count(*) AS rows_total, count(*) AS scanned_without_optimization,
  count(*) FILTER (service_month = DATE '{SCAN_MONTH}') AS scanned_partition_only,
  count(*) FILTER ({_HIT}) AS scanned_partition_plus_cluster,
  {half_up(f'100 * count(*) FILTER (NOT ({_HIT}))', 'count(*)', 2)}
    AS cost_reduction_vs_full_scan_pct
FROM fact""")

_LINES = """
nested AS (
  SELECT concat('RO', l_orderkey) AS ro_number, CAST(o_orderdate AS DATE) AS service_date,
    o_custkey % 100 AS dealer_key, concat('OP', l_linenumber) AS op_code,
    concat(l_returnflag, '/', l_linestatus) AS description,
    CAST(l_quantity AS DECIMAL(18,2)) AS labor_hours,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
"""
ORACLE["nested_lines_build"] = over(_LINES, f"""
SELECT ro_number, {day('service_date')} AS service_date, dealer_key, CAST(0 AS INTEGER) AS part_no,
  count(*) AS line_count,
  CAST(sum(amount) AS DOUBLE) AS amount,
  string_agg(concat_ws(':', op_code, description, labor_hours, amount), ','
    ORDER BY op_code, description, labor_hours, amount) AS lines
FROM nested GROUP BY ro_number, service_date, nested.dealer_key""")
ORACLE["nested_lines_explode"] = over(_LINES, f"""
SELECT ro_number, {day('service_date')} AS service_date, dealer_key, op_code, description,
  CAST(labor_hours AS DOUBLE) AS labor_hours, CAST(amount AS DOUBLE) AS amount FROM nested""")

# --- retention -------------------------------------------------------------------------------


def _visits(before: str = "TRUE") -> str:
    f = f"FILTER ({before})"
    n = f"count(*) {f}"
    share = half_up(f"sum(CASE WHEN pay_type = 'customer' THEN cents ELSE 0 END) {f}",
                    f"sum(cents) {f}", 6)
    return f"""{n} AS prior_visits, max(service_date) {f} AS last_visit,
    {half_up(f'sum(satisfaction_score) {f}', f'count(satisfaction_score) {f}', 6)}
      AS avg_satisfaction,
    {half_up(f'sum(days_to_close) {f}', n, 6)} AS avg_wait_days,
    {half_up(f'sum(repeat_repair_flag) {f}', n, 6)} AS repeat_repair_rate,
    {share} AS customer_pay_share,
    CAST(sum(total_amount) {f} AS DOUBLE) AS total_service_spend,
    CAST(max(CASE WHEN service_type = 'recall' THEN 1 ELSE 0 END) {f} AS INTEGER) AS had_recall"""


def _ages(as_of: str) -> str:
    d = f"DATE '{as_of}'"
    return f"""CAST(date_diff('year', in_service_date, {d}) AS INTEGER) AS vehicle_age,
    CASE WHEN date_diff('year', in_service_date, {d}) <= 3 THEN 1 ELSE 0 END AS in_warranty,
    CAST(date_diff('month', last_visit, {d}) AS INTEGER) AS months_since_last_service"""


_FEATURES = f"""
visits AS (
  SELECT f.customer_key, model, in_service_date, {_visits()}
  FROM fact f JOIN cust c ON c.customer_key = f.customer_key
  JOIN vehicle v ON v.vehicle_key = f.vehicle_key
  GROUP BY f.customer_key, model, in_service_date),
features AS (SELECT *, {_ages(AS_OF)} FROM visits),
"""
fact("retention_features", f"""
SELECT customer_key, model, {day('in_service_date')} AS in_service_date, vehicle_age, in_warranty,
  prior_visits, months_since_last_service, avg_satisfaction, avg_wait_days, repeat_repair_rate,
  customer_pay_share, total_service_spend, had_recall
FROM features""", _FEATURES)

_BEFORE = f"service_date <= DATE '{HISTORY_CUTOFF}'"
_HISTORY = f"""
per_customer AS (
  SELECT customer_key, {_visits(_BEFORE)},
    CAST(coalesce(max(CASE WHEN service_date > DATE '{HISTORY_CUTOFF}' AND service_date <=
      DATE '{HISTORY_CUTOFF}' + INTERVAL {HISTORY_MONTHS} MONTH THEN 1 ELSE 0 END), 0)
      AS INTEGER) AS retained_next_period
  FROM fact GROUP BY customer_key),
last_visit AS (
  SELECT customer_key, dealer_key, vehicle_key FROM fact WHERE {_BEFORE}
  QUALIFY row_number() OVER (PARTITION BY customer_key
    ORDER BY service_date DESC, ro_number DESC) = 1),
history AS (
  SELECT p.customer_key, dealer_id, region, model, model_year, {_ages(HISTORY_CUTOFF)},
    prior_visits, avg_satisfaction, avg_wait_days, repeat_repair_rate, customer_pay_share,
    CAST(abs(c_nationkey - s_nationkey) * 10 AS INTEGER) AS distance_to_dealer_mi,
    total_service_spend, had_recall, retained_next_period, l.dealer_key
  FROM (SELECT * FROM per_customer WHERE prior_visits > 0) p
  JOIN last_visit l ON l.customer_key = p.customer_key
  JOIN cust c ON c.customer_key = p.customer_key
  JOIN dealer d ON d.dealer_key = l.dealer_key
  JOIN vehicle v ON v.vehicle_key = l.vehicle_key),
scored AS (
  SELECT *, round(least(CAST(1 AS DOUBLE), months_since_last_service * CAST(0.05 AS DOUBLE)
    + repeat_repair_rate * CAST(0.4 AS DOUBLE)
    + (1 - customer_pay_share) * CAST(0.2 AS DOUBLE)), 6) AS churn_risk
  FROM history),
actioned AS (
  SELECT *, CASE
      WHEN avg_satisfaction < 3.5 OR repeat_repair_rate > 0.25 THEN 'service_recovery_outreach'
      WHEN in_warranty = 1 AND vehicle_age >= 3 THEN 'warranty_expiry_offer'
      WHEN months_since_last_service > 8 THEN 'lapsed_maintenance_reminder'
      WHEN had_recall = 1 THEN 'recall_completion_followup'
      WHEN customer_pay_share > 0.6 THEN 'loyalty_discount'
      ELSE 'personalized_service_reminder' END AS recommended_action
  FROM scored),
valued AS (
  SELECT *, round(CAST(churn_risk AS DECIMAL(20,12)) * CASE recommended_action
      WHEN 'service_recovery_outreach' THEN 5 WHEN 'warranty_expiry_offer' THEN 4
      WHEN 'lapsed_maintenance_reminder' THEN 3 WHEN 'recall_completion_followup' THEN 3
      WHEN 'loyalty_discount' THEN 2 ELSE 1 END, 3) AS expected
  FROM actioned),
targeted AS (
  SELECT *, CAST(expected AS DOUBLE) AS expected_value FROM valued
  QUALIFY row_number() OVER (ORDER BY churn_risk DESC, customer_key)
    <= floor(count(*) OVER () * CAST(0.15 AS DOUBLE))),
"""
fact("customer_service_history", "SELECT * EXCLUDE (dealer_key) FROM history", _HISTORY)
_CSV_NUMBERS = {*FEATURES, "retained_next_period"}
fact("history_from_csv", "SELECT " + ", ".join(
    f"CAST({c} AS {'DOUBLE' if c in _CSV_NUMBERS else 'VARCHAR'}) AS {c}" for c in HISTORY_CSV.fieldNames())
    + " FROM history", _HISTORY)
_KEPT = half_up("100 * sum(retained_next_period)", "count(*)", 1)
fact("retention_by_region", f"""
SELECT region, count(*) AS customers, {_KEPT} AS retention_rate_pct
FROM history GROUP BY region""", _HISTORY)
fact("retention_by_warranty", f"""
SELECT CASE WHEN in_warranty = 1 THEN 'In warranty' ELSE 'Out of warranty' END AS segment,
  count(*) AS customers, {_KEPT} AS retention_rate_pct FROM history GROUP BY 1""", _HISTORY)
fact("retention_kpis", f"""
SELECT 'overall' AS dimension, 'all' AS segment, count(*) AS customers,
  {_KEPT} AS retention_rate_pct FROM history
UNION ALL SELECT 'warranty', CASE WHEN in_warranty <> 0 THEN 'in_warranty' ELSE 'out_of_warranty'
  END, count(*), {_KEPT} FROM history GROUP BY 2
UNION ALL SELECT 'region', region, count(*), {_KEPT} FROM history GROUP BY region
UNION ALL SELECT 'model', model, count(*), {_KEPT} FROM history GROUP BY model""", _HISTORY)
fact("report_files", """
SELECT 'overall' AS part, 'all' AS item, count(*) AS customers FROM history
UNION ALL SELECT 'warranty', CASE WHEN in_warranty <> 0 THEN 'in_warranty' ELSE 'out_of_warranty' END, count(*)
FROM history GROUP BY 2
UNION ALL SELECT 'region', region, count(*) FROM history GROUP BY region
UNION ALL SELECT 'model', model, count(*) FROM history GROUP BY model
UNION ALL SELECT 'action', recommended_action, count(*) FROM targeted GROUP BY recommended_action""", _HISTORY)
fact("at_risk_by_region", """
SELECT customer_key, region, churn_risk, recommended_action,
  CAST(expected AS DOUBLE) AS expected_value FROM valued
QUALIFY row_number() OVER (PARTITION BY region ORDER BY churn_risk DESC, customer_key) <= 500
""", _HISTORY)
fact("at_risk_top_decile_by_region", """
SELECT customer_key, region, churn_risk FROM scored
QUALIFY row_number() OVER (PARTITION BY region ORDER BY churn_risk DESC, customer_key)
  <= floor(count(*) OVER (PARTITION BY region) * CAST(0.1 AS DOUBLE))""", _HISTORY)
fact("at_risk_by_model", f"""
SELECT model, customer_key, {day('in_service_date')} AS in_service_date,
  months_since_last_service / CAST(100 AS DOUBLE) AS churn_risk FROM features
QUALIFY row_number() OVER (PARTITION BY model
  ORDER BY months_since_last_service DESC, customer_key, in_service_date) <= 500""", _FEATURES)
fact("at_risk_top_pct", "SELECT customer_key, region, churn_risk FROM targeted", _HISTORY)
fact("outreach_action_mix", """
SELECT recommended_action, count(*) AS customers FROM targeted GROUP BY recommended_action
""", _HISTORY)
fact("outreach_recommendations", """
SELECT customer_key, region, CAST(round(CAST(churn_risk AS DECIMAL(20,12)), 3) AS DOUBLE)
  AS churn_risk, recommended_action, expected_value
FROM targeted ORDER BY targeted.churn_risk DESC, customer_key LIMIT 20""", _HISTORY)

_CURVE = _FEATURES + """
groups AS (
  SELECT months_since_last_service AS score, sum(had_recall) AS pos, count(*) AS n
  FROM features GROUP BY 1),
totals AS (SELECT sum(pos) AS p, sum(n) AS t FROM groups),
curve AS (
  SELECT *, sum(pos) OVER (ORDER BY score) - pos AS pos_below,
    sum(n) OVER (ORDER BY score) - n AS n_below
  FROM groups),
"""
fact("metric_auc", """
SELECT round(CAST(sum(pos * (2 * (n_below - pos_below) + (n - pos))) AS DOUBLE)
  / (2 * any_value(p) * (any_value(t) - any_value(p))), 6) AS roc_auc
FROM curve, totals""", _CURVE)
fact("metric_average_precision", """
SELECT round(sum(pos * (CAST(p - pos_below AS DOUBLE) / (t - n_below))) / any_value(p), 6)
  AS average_precision FROM curve, totals""", _CURVE)
fact("lift_at_k", """
SELECT count(*) AS targeted, round(avg(1 - retained_next_period)
  / (SELECT avg(1 - retained_next_period) FROM scored), 6) AS lift
FROM (SELECT * FROM scored QUALIFY row_number() OVER (ORDER BY churn_risk DESC, customer_key)
  <= greatest(1, (SELECT count(*) FROM scored) // 10))""", _HISTORY)

fact("churn_split_counts", """
SELECT churned, is_train, CASE is_train WHEN 0 THEN held ELSE n - held END AS customers
FROM (SELECT CAST(1 - retained_next_period AS INTEGER) AS churned, count(*) AS n,
  CAST(round(count(*) * 0.25) AS BIGINT) AS held FROM history GROUP BY 1)
CROSS JOIN (SELECT CAST(0 AS INTEGER) AS is_train UNION ALL SELECT 1)""", _HISTORY)

_SPLIT = """
ordered AS (
  SELECT customer_key, region, CAST(1 - retained_next_period AS INTEGER) AS churned,
    row_number() OVER (PARTITION BY retained_next_period
      ORDER BY md5('42:' || customer_key), customer_key) AS nth,
    count(*) OVER (PARTITION BY retained_next_period) AS n
  FROM history),
"""
fact("churn_split", """
SELECT customer_key, region, churned, CAST(nth > round(n * 0.25) AS INTEGER) AS is_train FROM ordered
""", _HISTORY + _SPLIT)

# --- governance ------------------------------------------------------------------------------

fact("erase_customers", """
SELECT customer_key, email_hash, phone_last4, consent_status FROM cust
WHERE consent_status <> 'ccpa_opt_out'""")
fact("erase_from_files", """
SELECT customer_key, email_hash, phone_last4, consent_status FROM cust
WHERE consent_status <> 'ccpa_opt_out' OR customer_key % 5 <> 0""")
_CUT = f"date_trunc('month', DATE '{AS_OF}') - INTERVAL 36 MONTH"
fact("retention_tiering", f"""
SELECT 'detail' AS tier, ro_number, {day('service_month')} AS service_month, dealer_key,
  CAST(1 AS BIGINT) AS ro_count, CAST(total_amount AS DOUBLE) AS total_amount
FROM fact WHERE service_month >= {_CUT}
UNION ALL SELECT 'monthly', NULL, {day('service_month')}, dealer_key, count(*),
  CAST(sum(total_amount) AS DOUBLE)
FROM fact WHERE service_month < {_CUT} GROUP BY service_month, dealer_key""")
fact("expire_partitions",
     _CURATED + " WHERE service_month >= DATE '2004-12-31' - INTERVAL 2555 DAY")
fact("external_share_extract", f"""
SELECT ro_number, customer_key, {day('service_date')} AS service_date, service_type,
  CAST(total_amount AS DOUBLE) AS total_amount
FROM fact WHERE customer_key IN
  (SELECT customer_key FROM cust WHERE consent_status <> 'ccpa_opt_out')""")
fact("access_analyst_view", f"""
SELECT vehicle_key, model, model_year, warranty_months, {day('in_service_date')}
  AS in_service_date FROM vehicle""")
fact("scd2_dealer", f"""
SELECT dealer_key, dealer_name, region, service_bays, '{HISTORY_OPEN}' AS effective_from,
  CASE WHEN dealer_key % 10 = 0 OR dealer_key % 25 = 7 THEN '{HISTORY_CHANGE}' END
    AS effective_to,
  CASE WHEN dealer_key % 10 = 0 OR dealer_key % 25 = 7 THEN 0 ELSE 1 END AS is_current
FROM dealer
UNION ALL SELECT dealer_key, dealer_name, region, service_bays + 1, '{HISTORY_CHANGE}', NULL, 1
FROM dealer WHERE dealer_key % 10 = 0 AND dealer_key % 25 <> 7
UNION ALL SELECT dealer_key + 1000000000, dealer_name, region, service_bays,
  '{HISTORY_CHANGE}', NULL, 1 FROM dealer WHERE dealer_key % 50 = 3""")

_TABLES = [
    ("fact_repair_orders", "fact",
     ["ro_number", "dealer_key", "vehicle_key", "customer_key", "service_type", "pay_type",
      "total_amount"]),
    ("dim_customer", "cust", ["customer_key", "email_hash", "phone_last4", "consent_status"]),
    ("dim_vehicle", "vehicle",
     ["vehicle_key", "vin", "model", "model_year", "warranty_months", "in_service_date"]),
    ("dim_dealer", "dealer",
     ["dealer_key", "dealer_id", "dealer_name", "region", "service_bays"]),
]
_LABELS = {
    ("fact_repair_orders", "ro_number"): "INTERNAL",
    ("fact_repair_orders", "total_amount"): "INTERNAL",
    ("fact_repair_orders", "satisfaction_score"): "INTERNAL",
    ("dim_customer", "email_hash"): "PII_INDIRECT",
    ("dim_customer", "phone_last4"): "PII_INDIRECT",
    ("dim_customer", "consent_status"): "INTERNAL",
    ("dim_vehicle", "vin"): "PII_INDIRECT",
}
fact("catalog_pii_audit", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, CAST(0 AS INTEGER) AS raw_pii_columns,"
    f" count(*) FILTER (concat_ws('', {', '.join(f'CAST({c} AS VARCHAR)' for c in cols)})"
    f" LIKE '%@%') AS rows_with_email FROM {cte}"
    for name, cte, cols in _TABLES) + "".join(
    f"\nUNION ALL SELECT '{name}', 0, 0" for name in ("dim_date", "dq_rejects", "etl_audit")))
fact("catalog_conformance", "\nUNION ALL\n".join([
    f"SELECT '{name}' AS table_name, '{c}' AS column_name,"
    f" '{_LABELS.get((name, c), 'INTERNAL')}' AS classification,"
    f" '{'conforming' if (name, c) in _LABELS else 'undeclared'}' AS status,"
    f" count({c}) AS filled_rows FROM {cte}"
    for name, cte, cols in _TABLES for c in cols
] + ["SELECT 'fact_repair_orders', 'satisfaction_score', 'INTERNAL', 'declared_only', 0"]))
# What the source tables' customer names and vehicle numbers end up in.
_MADE_OF = "table_name = 'dim_vehicle' AND column_name IN ('vin', 'vehicle_key') OR column_name = 'email_hash'"
ORACLE["catalog_derived_labels"] = f"""
SELECT *, CASE WHEN status = 'declared_only' THEN NULL WHEN {_MADE_OF} THEN 'PII_INDIRECT' ELSE 'INTERNAL' END AS derived,
  CAST(column_name = 'vehicle_key' AND table_name = 'dim_vehicle' AS INTEGER) AS exposed
FROM ({ORACLE["catalog_conformance"]})"""

# --- streaming -------------------------------------------------------------------------------

_ACCEPTED = f"service_type IN ({quoted(FEED_TYPES)}) AND total_amount >= 0"
_EVENT = f"""
SELECT ro_number, dealer_key, {day('service_date')} AS service_date, service_type,
  CAST(total_amount AS DOUBLE) AS total_amount, satisfaction_score FROM ev WHERE {_ACCEPTED}"""
ORACLE["stream_valid_events"] = over(_EVENTS, _EVENT)
ORACLE["stream_dedup"] = over(_EVENTS, _EVENT)
ORACLE["stream_dead_letter"] = over(_EVENTS, f"""
SELECT '{{"ro_number":"' || ro_number || '","dealer_key":' || dealer_key || ',"service_date":"'
  || {day('service_date')} || '","service_type":"' || service_type || '","total_amount":'
  || total_amount || ',"satisfaction_score":' || satisfaction_score || '}}' AS raw,
  CASE WHEN service_type NOT IN ({quoted(FEED_TYPES)}) THEN 'invalid_service_type'
    ELSE 'negative_total_amount' END AS error
FROM ev WHERE NOT ({_ACCEPTED})""")
ORACLE["stream_monthly_mart"] = over(_EVENTS, f"""
SELECT {day("date_trunc('month', service_date)")} AS month, dealer_key, count(*) AS ro_count,
  CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
  CAST(sum(satisfaction_score) AS BIGINT) AS score_sum,
  count(satisfaction_score) AS score_count
FROM ev WHERE {_ACCEPTED} GROUP BY ALL""")
