"""SQL twins of the adapters: shared tables (``d_...``) that the oracle queries of each plan start from."""

from __future__ import annotations

from coverlake.adapters import AS_OF, LIABILITY_CODES, PRODUCTS, WORK_NAMES, WORK_RISK

TODAY = f"DATE '{AS_OF.isoformat()}'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


def cert_sql(key: str, area: str) -> str:
    full = (
        f"CAST((110000 + ({area}) * 1000) * 1000000000000 + ((({key}) % 50 + 1950) * 10000 + (({key}) % 12 + 1) * 100 + ({key}) % 28 + 1) * 10000 "
        f"+ (({key}) % 1000) * 10 + ({key}) % 10 AS VARCHAR)"
    )
    return (
        f"CASE WHEN ({key}) % 50 = 49 THEN substr({full}, 1, 14) || '**' || substr({full}, 17, 2) "
        f"WHEN ({key}) % 70 = 69 THEN substr({full}, 1, 15) ELSE {full} END"
    )


def mobile_sql(key: str) -> str:
    return f"'1' || lpad(CAST(({key}) * 7919 % 100000 AS VARCHAR), 10, '0')"


def half_up(price: str, n: str) -> str:
    """price / n rounded half up to four places, in integers because SQL division here would give a double."""
    return (
        f"CAST(((CAST({price} * 10000 AS BIGINT) * 2 + {n}) // (2 * {n})) * CAST(0.0001 AS DECIMAL(14,4)) AS DECIMAL(14,4))"
    )


def age_sql(cert: str, when: str) -> str:
    y, m, d = (f"TRY_CAST(substr({cert}, {a}, {n}) AS INTEGER)" for a, n in ((7, 4), (11, 2), (13, 2)))
    reached = f"(CASE WHEN month({when}) > {m} OR (month({when}) = {m} AND day({when}) >= {d}) THEN 1 ELSE 0 END)"
    return (
        f"CASE WHEN length({cert}) = 18 AND {y} >= 1919 AND {m} BETWEEN 1 AND 12 AND {d} BETWEEN 1 AND 31 "
        f"AND {when} IS NOT NULL THEN CASE WHEN year({when}) < {y} THEN 0 "
        f"ELSE year({when}) - {y} + {reached} END ELSE 0 END"
    )


def gap_sql(start: str, end: str) -> str:
    return f"(CASE WHEN datediff('day', {start}, {end}) = 0 THEN 1 ELSE datediff('day', {start}, {end}) END)"


_LINE_ID = (
    "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || "
    "CAST(l_suppkey AS VARCHAR) || '-' || CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR)"
)
_XP = "CAST(l_extendedprice AS DECIMAL(14,2))"

CTES: dict[str, str] = {
    "d_area": """
SELECT n_nationkey, CAST(110000 + n_nationkey * 1000 AS VARCHAR) AS code, n_name AS city, r_name AS province
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "d_customer": f"""
SELECT c_custkey AS holder_id, c_name AS holder_name, {cert_sql('c_custkey', 'c_nationkey')} AS holder_cert_no,
  {mobile_sql('c_custkey')} AS holder_mobile, c_mktsegment AS product_code, code AS region_code, city, province,
  CAST(c_acctbal AS DECIMAL(14,4)) AS balance
FROM customer LEFT JOIN d_area ON c_nationkey = n_nationkey""",
    "d_policy": """
SELECT o_orderkey AS policy_id, 'P' || CAST(o_orderkey AS VARCHAR) AS policy_code, o_custkey AS holder_id,
  CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 ELSE -1 END AS policy_status,
  CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS charge_type,
  CAST(o_orderdate AS DATE) AS start_date,
  CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 2 = 0 THEN 29 ELSE 364 END AS end_date,
  CAST(o_totalprice AS DECIMAL(14,4)) AS first_premium,
  CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(14,4)) AS price,
  CAST(o_orderkey % 20 + 1 AS INTEGER) AS person_count, o_orderpriority AS insurer,
  holder_name, holder_cert_no, holder_mobile, product_code,
  CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN substr(region_code, 1, 4) ELSE region_code END AS region_code,
  city AS channel, province, balance
FROM orders LEFT JOIN d_customer ON o_custkey = holder_id""",
    "d_policy_chain": """
SELECT *, lag(policy_id) OVER (PARTITION BY holder_id ORDER BY start_date, policy_id) AS predecessor_id FROM d_policy""",
    "d_line": f"""
SELECT lineitem.*, {_LINE_ID} AS line_id, CAST(o_orderdate AS DATE) AS order_day
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "d_insured": f"""
SELECT line_id AS insured_id, l_orderkey AS policy_id, l_partkey AS person_id,
  {cert_sql('l_partkey', 'l_partkey % 25')} AS cert_no, {mobile_sql('l_partkey')} AS mobile,
  CASE WHEN l_linenumber = 7 AND l_discount = 0 THEN NULL ELSE order_day + (l_linenumber * 5 - 10) END AS start_date,
  CASE WHEN l_linenumber = 1 AND l_tax = 0 THEN NULL
       ELSE order_day + (l_linenumber * 5 - 10) + CAST(l_quantity AS INTEGER) END AS end_date,
  l_suppkey AS workplace_id
FROM d_line""",
    "d_insured_work": """
SELECT i.*, CASE WHEN p_size % 10 <> 0 THEN p_type END AS work_type FROM d_insured i LEFT JOIN part ON person_id = p_partkey""",
    "d_dependant": f"""
SELECT {_LINE_ID} AS master_id, 'S' || CAST(l_suppkey AS VARCHAR) AS slave_name,
  {cert_sql('l_suppkey', 'l_suppkey % 25')} AS slave_cert_no
FROM lineitem WHERE l_returnflag = 'A'""",
    "d_endorsement": f"""
SELECT line_id AS preserve_id, l_orderkey AS policy_id, CAST(l_suppkey % 3 + 1 AS INTEGER) AS preserve_type,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS preserve_status,
  CAST({_XP} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,4)) AS add_premium,
  CAST(-({_XP} * CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(14,4)) AS del_premium,
  CAST(l_quantity AS INTEGER) AS add_person_count, l_linenumber AS del_person_count,
  order_day + l_linenumber AS effective_date
FROM d_line""",
    "d_claim_raw": f"""
SELECT line_id AS case_no, l_orderkey AS policy_id, l_partkey AS person_id,
  {cert_sql('l_partkey', 'l_partkey % 25')} AS risk_cert_no,
  CASE WHEN l_tax = 0 THEN '' WHEN l_suppkey % 2 = 0 THEN strftime(order_day + CAST(l_partkey % 60 AS INTEGER), '%Y/%m/%d')
       ELSE strftime(order_day + CAST(l_partkey % 60 AS INTEGER), '%Y-%m-%d') END AS risk_date,
  CAST(CAST({_XP} * CAST(0.1 AS DECIMAL(3,1)) AS DECIMAL(14,4)) AS VARCHAR) AS pre_com,
  CASE WHEN l_linestatus = 'F' THEN CAST(CAST({_XP} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,4)) AS VARCHAR) ELSE '' END AS final_payment,
  CASE WHEN l_linestatus = 'F' THEN '结案' ELSE '处理中' END AS case_status,
  CASE WHEN l_linenumber % 2 = 0 THEN '死亡' ELSE '伤残' END AS case_type
FROM d_line WHERE l_returnflag = 'R'""",
    "d_claim_source": f"""
SELECT 'C' || {_LINE_ID} AS claim_no, CASE WHEN l_linestatus = 'F' THEN 'N' || {_LINE_ID} END AS notice_no,
  CASE WHEN l_tax = 0.08 THEN -1 ELSE 1 END AS status,
  [{', '.join(repr(c) for c in LIABILITY_CODES)}][(l_linenumber + l_suppkey) % {len(LIABILITY_CODES)} + 1] AS liability_code,
  CAST({_XP} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,4)) AS amount, l_orderkey AS policy_id,
  {mobile_sql('l_partkey')} AS mobile, CASE WHEN l_tax > 0 THEN CAST(l_shipdate AS DATE) END AS loss_day
FROM lineitem WHERE l_returnflag = 'R'""",
    "d_claim": """
SELECT case_no, policy_id, person_id, risk_cert_no, case_status, case_type,
  CASE WHEN length(risk_date) > 7 THEN CAST(replace(risk_date, '/', '-') AS DATE) END AS risk_day,
  CAST(CASE WHEN final_payment IS NULL OR final_payment = '' THEN pre_com ELSE final_payment END AS DECIMAL(14,4)) AS payable,
  CAST(CASE WHEN final_payment = '' THEN NULL ELSE final_payment END AS DECIMAL(14,4)) AS settled,
  CAST(pre_com AS DECIMAL(14,4)) AS reserve
FROM d_claim_raw""",
    "d_product": f"""
SELECT * FROM (VALUES {_values(PRODUCTS)}) t(product_code, product_name, one_level, two_level, business_line)""",
    "d_sales": """
SELECT holder_name AS ent_name, md5(holder_name) AS ent_id,
  CASE WHEN holder_id % 5 = 0 THEN '直客' ELSE city END AS channel_name, s_name AS salesman,
  'OP-' || province AS biz_operator, CASE WHEN balance < 0 THEN 'old' ELSE 'new' END AS consumer_new_old,
  CASE WHEN holder_id % 3 = 0 THEN '' ELSE '线上' END AS business_source
FROM d_customer LEFT JOIN supplier ON holder_id % 100 = s_suppkey""",
    "d_sales_team": """
SELECT s_name AS sale_name, city AS team_name, province AS department,
  CASE WHEN s_acctbal >= 5000 THEN province END AS group_name
FROM supplier LEFT JOIN d_area ON s_nationkey = n_nationkey""",
    "d_plan": """
SELECT policy_id, product_code, price AS sku_price, CAST(person_count * 10 AS DECIMAL(14,4)) AS sku_coverage,
  CASE WHEN charge_type = 2 THEN '1' ELSE '2' END AS sku_ratio, charge_type AS sku_charge_type,
  CAST((policy_id % 7) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(14,4)) AS tech_rate,
  CASE WHEN policy_id % 11 = 0 THEN NULL ELSE CAST((policy_id % 13) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(14,4)) END AS broker_rate
FROM d_policy""",
    "d_work_match": f"SELECT * FROM (VALUES {_values(WORK_NAMES.items())}) t(primitive_work, work_name_check)",
    "d_work_risk": f"SELECT * FROM (VALUES {_values([(n, r, g) for n, (r, g) in WORK_RISK.items()])}) t(standard_work_name, standard_work_risk, gs_work_risk)",
    "d_work_grade": """
SELECT o_orderkey AS policy_id, CASE o_orderkey % 4 WHEN 0 THEN '1-3类' WHEN 1 THEN '1-4类' WHEN 2 THEN '5类' ELSE '' END AS profession_type
FROM orders""",
    "d_watch_list": """
SELECT holder_name AS ent_name, CASE WHEN balance < -500 THEN 1 ELSE 2 END AS colour FROM d_customer WHERE balance < 0""",
    "d_change_log": """
SELECT user_id AS key, event_id AS seq,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS type, value, props
FROM events""",
    "d_calendar": """
SELECT CAST(d AS DATE) AS d_day FROM generate_series(DATE '1994-01-01', DATE '2003-12-31', INTERVAL 1 DAY) g(d)""",
}
