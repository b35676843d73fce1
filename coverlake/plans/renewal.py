"""Renewals, open business, daily operations and month comparisons."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.adapters import AS_OF, MONEY, Tables
from coverlake.operators import premium as P
from coverlake.operators import renewal as R
from coverlake.oracle import CTES, TODAY
from coverlake.plans.premium import RUNS, cover, equal_runs, ledger
from coverlake.plans.settlement import sellers
from coverlake.registry import query

REPORT_DAY = date(2001, 7, 3)
OPERATOR_DAY = date(2024, 1, 10)

# People who stay: a brand stands for the person, and long covers run to the end of the policy or beyond it.
CTES["x_stayer"] = """
SELECT i.insured_id, i.policy_id, 'B' || CAST(person_id % 25 AS VARCHAR) AS cert_no, i.start_date,
  CASE WHEN datediff('day', i.start_date, i.end_date) >= 20 THEN greatest(i.end_date, p.end_date) ELSE i.end_date END AS end_date
FROM d_insured i JOIN d_policy p ON p.policy_id = i.policy_id WHERE i.start_date IS NOT NULL AND i.end_date IS NOT NULL"""


def stayers(t: Tables) -> DataFrame:
    ends = t.policy.select("policy_id", F.col("end_date").alias("p_end"))
    known = t.insured.where("start_date is not null and end_date is not null").join(ends, "policy_id")
    stays = F.datediff("end_date", "start_date") >= 20
    return known.select(
        "insured_id", "policy_id", F.concat(F.lit("B"), F.pmod("person_id", F.lit(25)).cast("string")).alias("cert_no"), "start_date",
        F.when(stays, F.greatest("end_date", "p_end")).otherwise(F.col("end_date")).alias("end_date"),
    )


@query("annual_renewal", "policy_id:long holder_name:str start_date:str end_date:str due_day:str due_month:str due_quarter:str current:long due_people:long renewed:long", f"""
WITH a AS (SELECT * FROM d_policy WHERE policy_status IN (0, 1) AND charge_type = 2),
c AS (SELECT s.policy_id, cert_no, s.start_date AS s, s.end_date AS e, holder_name, p.start_date AS ps, p.end_date AS pe FROM x_stayer s JOIN a p ON p.policy_id = s.policy_id),
h AS (SELECT policy_id, count(DISTINCT cert_no) FILTER (greatest(s, ps) <= pe - 30 AND least(e, pe) >= pe - 30) AS due_people,
  count(DISTINCT cert_no) FILTER (greatest(s, ps) <= {TODAY} AND least(e, pe) >= {TODAY}) AS current FROM c GROUP BY 1),
r AS (SELECT l.policy_id, count(DISTINCT l.cert_no) AS renewed FROM c l JOIN c n ON n.holder_name = l.holder_name AND n.cert_no = l.cert_no
  WHERE n.s <= l.pe + 30 AND n.e >= l.pe + 30 AND n.ps >= l.pe AND l.s <= greatest(l.pe - 30, l.ps) AND l.e >= greatest(l.pe - 30, l.ps) GROUP BY 1)
SELECT a.policy_id, holder_name, start_date, end_date, end_date + 1 AS due_day, strftime(end_date + 1, '%Y%m') AS due_month,
  strftime(end_date + 1, '%Y') || '-Q' || CAST(quarter(end_date + 1) AS VARCHAR) AS due_quarter, coalesce(current, 0) AS current,
  coalesce(due_people, 0) AS due_people, coalesce(renewed, 0) AS renewed
FROM a LEFT JOIN h ON h.policy_id = a.policy_id LEFT JOIN r ON r.policy_id = a.policy_id""")
def annual_renewal(t: Tables) -> DataFrame:
    people = stayers(t)
    return R.annual_renewal(t.policy, people, P.clamped_cover(people, t.policy), AS_OF)


@query("monthly_renewal", "policy_id:long holder_name:str effect_month:str reference_month:str due_day:str start_day:str end_day:str renewed_day:str", """
WITH m AS (SELECT policy_id, holder_name, start_date, end_date, CAST(unnest(generate_series(date_trunc('month', start_date), date_trunc('month', end_date), INTERVAL 1 MONTH)) AS DATE) AS month
  FROM d_policy WHERE charge_type = 1),
e AS (SELECT policy_id, strftime(effective_date, '%Y%m') AS ref, max(effective_date) AS renewed_day FROM d_endorsement GROUP BY 1, 2)
SELECT m.policy_id, holder_name, strftime(greatest(start_date, month), '%Y%m') AS effect_month, strftime(last_day(month) + 1, '%Y%m') AS reference_month,
  last_day(month) + 1 AS due_day, greatest(start_date, month) AS start_day,
  CASE WHEN month <= start_date THEN last_day(month) ELSE least(last_day(month), end_date) END AS end_day, renewed_day
FROM m LEFT JOIN e ON e.policy_id = m.policy_id AND e.ref = strftime(last_day(month) + 1, '%Y%m')""")
def monthly_renewal(t: Tables) -> DataFrame:
    changes = t.endorsement.select("policy_id", F.col("effective_date").alias("preserve_start"), F.lit(None).cast("date").alias("preserve_end"))
    return R.monthly_renewal(t.policy, changes)


@query("proposal_renewal", "policy_id:long holder_name:str start_date:str end_date:str due_day:str effect_month:str next_id:long renewed_day:str", f"""
SELECT p.policy_id, p.holder_name, p.start_date, p.end_date, p.end_date + 1 AS due_day, strftime(p.start_date, '%Y%m') AS effect_month, n.policy_id AS next_id,
  CASE WHEN n.end_date IS NOT NULL THEN least(n.end_date, {TODAY}) END AS renewed_day
FROM d_policy p LEFT JOIN d_policy_chain n ON n.predecessor_id = p.policy_id WHERE p.charge_type = 1""")
def proposal_renewal(t: Tables) -> DataFrame:
    return R.proposal_renewal(t.policy_chain, AS_OF)


CTES["x_proposal"] = """
SELECT policy_code, holder_name, start_date AS created, person_count AS people, CAST(policy_id % 8 + 1 AS INTEGER) AS status, CAST(policy_id % 2 + 1 AS INTEGER) AS payment_status,
  CAST(policy_id % 3 + 1 AS INTEGER) AS ledger_status FROM d_policy"""
CTES["x_change_order"] = """
SELECT 'P' || CAST(e.policy_id AS VARCHAR) AS policy_code, preserve_id AS order_no, holder_name, effective_date AS created, add_person_count AS people,
  [1, 3, 7, 2][CAST(e.policy_id % 4 AS INTEGER) + 1] AS status, preserve_status FROM d_endorsement e JOIN d_policy p ON p.policy_id = e.policy_id"""
CTES["x_open_items"] = f"""
SELECT policy_code, CAST(NULL AS VARCHAR) AS order_no, holder_name, CASE WHEN status IN (1, 2) THEN status WHEN status = 3 AND payment_status = 1 THEN 3
  WHEN status = 3 AND ledger_status IN (1, 3) AND payment_status = 2 THEN 4 WHEN status = 5 THEN 5 WHEN status IN (6, 7) THEN 6 ELSE 8 END AS state, created, people
FROM x_proposal WHERE created >= {TODAY} - 5 AND policy_code NOT IN (SELECT policy_code FROM d_policy WHERE policy_status = 1)
UNION ALL SELECT policy_code, order_no, holder_name, CASE status WHEN 1 THEN 1 WHEN 3 THEN 2 WHEN 7 THEN 5 ELSE 8 END, created, people
FROM x_change_order WHERE created >= {TODAY} - 5 AND order_no NOT IN (SELECT preserve_id FROM d_endorsement WHERE preserve_status = 1)"""


def open_items(t: Tables) -> DataFrame:
    i = F.col("policy_id")
    proposal = t.policy.select(
        "policy_code", "holder_name", F.col("start_date").alias("created"), F.col("person_count").alias("people"),
        (F.pmod(i, F.lit(8)) + 1).cast("int").alias("status"), (F.pmod(i, F.lit(2)) + 1).cast("int").alias("payment_status"),
        (F.pmod(i, F.lit(3)) + 1).cast("int").alias("ledger_status"),
    )
    states = F.array(F.lit(1), F.lit(3), F.lit(7), F.lit(2))
    change = t.endorsement.join(t.policy.select("policy_id", "policy_code", "holder_name"), "policy_id").select(
        "policy_code", F.col("preserve_id").alias("order_no"), "holder_name", F.col("effective_date").alias("created"),
        F.col("add_person_count").alias("people"), F.element_at(states, (F.pmod(i, F.lit(4)) + 1).cast("int")).alias("status"),
    )
    done = t.endorsement.where("preserve_status = 1").select(F.col("preserve_id").alias("order_no"))
    return R.open_items(proposal, t.policy.where("policy_status = 1"), change, done, AS_OF)


@query("open_items", "policy_code:str order_no:str holder_name:str state:long created:str people:long", "SELECT * FROM x_open_items")
def open_items_query(t: Tables) -> DataFrame:
    return open_items(t)


@query("renewal_reference_days", "policy_code:str holder_name:str state:long start_date:str reference:long matching:long current:long", f"""
WITH c AS (SELECT policy_id, count(DISTINCT cert_no) FILTER (DATE '2001-06-30' BETWEEN cover_start AND cover_end) AS reference,
  count(DISTINCT cert_no) FILTER (DATE '2001-07-05' BETWEEN cover_start AND cover_end) AS matching,
  count(DISTINCT cert_no) FILTER (DATE '{REPORT_DAY}' BETWEEN cover_start AND cover_end) AS current FROM x_cover GROUP BY 1)
SELECT policy_code, holder_name, 7 AS state, start_date, reference, matching, current FROM d_policy p LEFT JOIN c ON c.policy_id = p.policy_id
UNION ALL SELECT policy_code, holder_name, state, NULL, 0, people, 0 FROM x_open_items""")
def renewal_reference_days(t: Tables) -> DataFrame:
    return R.renewal_reference_days(t.policy, cover(t), open_items(t), REPORT_DAY)


@query("daily_operator_detail", "policy_id:long insurer:str kind:long sku_price:double sku_ratio:str add_people:long del_people:long premium:double", f"""
WITH o AS (SELECT event_id AS policy_id, coalesce(insurer, '-') AS insurer, event_type, ts, CAST(value AS DECIMAL(14,4)) AS premium, CAST(json_extract_string(props, '$.k') AS INTEGER) AS people
  FROM events LEFT JOIN d_policy ON policy_id = event_id),
x AS (SELECT policy_id, insurer, 4 AS kind, people AS add_people, 0 AS del_people, premium FROM o
  WHERE event_type <> 'error' AND ts BETWEEN TIMESTAMP '{OPERATOR_DAY}' AND TIMESTAMP '{OPERATOR_DAY} 18:00:00'
  UNION ALL SELECT policy_id, insurer, 1, people, 1, premium FROM o WHERE event_type = 'error' AND (
    (insurer LIKE '%HIGH%' AND ts BETWEEN TIMESTAMP '{OPERATOR_DAY}' AND TIMESTAMP '{OPERATOR_DAY} 18:00:00')
    OR (insurer NOT LIKE '%HIGH%' AND ts BETWEEN TIMESTAMP '{OPERATOR_DAY}' + INTERVAL 1 DAY AND TIMESTAMP '{OPERATOR_DAY} 18:00:00' + INTERVAL 1 DAY)))
SELECT x.*, CASE WHEN pl.policy_id IS NOT NULL THEN pl.sku_price ELSE premium END AS sku_price, CASE WHEN pl.policy_id IS NOT NULL THEN pl.sku_ratio ELSE '9' END AS sku_ratio
FROM x LEFT JOIN d_plan pl ON pl.policy_id = x.policy_id AND pl.sku_charge_type = 2""")
def daily_operator_detail(t: Tables) -> DataFrame:
    """Events as today's proposals, error events as changes; half of the policies have an issued plan."""
    policy = t.policy.select(F.col("policy_id").alias("event_id"), "insurer")
    rows = t.raw("events").join(policy, "event_id", "left").select(
        F.col("event_id").alias("policy_id"), F.coalesce("insurer", F.lit("-")).alias("insurer"), "event_type", F.col("ts").alias("insure_time"),
        F.col("ts").alias("effective_time"), F.col("value").cast(MONEY).alias("premium"), F.get_json_object("props", "$.k").cast("int").alias("people"),
        F.col("value").cast(MONEY).alias("sku_price"), F.lit("9").alias("sku_ratio"),
    )
    change = rows.where("event_type = 'error'").withColumn("add_people", F.col("people")).withColumn("del_people", F.lit(1))
    issued = t.plan.where("sku_charge_type = 2")
    return R.daily_operator_detail(rows.where("event_type <> 'error'"), change, issued, OPERATOR_DAY, "%HIGH%")


@query("month_over_month_headcount", "insurer:str day:str last_month_day:str head_count:long last_month_head_count:long", """
WITH d AS (SELECT insurer, day, sum(head_count) AS head_count FROM x_daily_headcount GROUP BY 1, 2)
SELECT a.insurer, a.day, CAST(a.day - INTERVAL 1 MONTH AS DATE) AS last_month_day, a.head_count, b.head_count AS last_month_head_count
FROM d a JOIN d b ON b.insurer = a.insurer AND b.day = CAST(a.day - INTERVAL 1 MONTH AS DATE)""")
def month_over_month_headcount(t: Tables) -> DataFrame:
    return R.month_over_month_headcount(P.clamped_cover(t.insured, t.policy, carry=("insurer",)), t.policy)


# Product chosen for the report by line and left out of it.
LINE, LEFT_OUT = "雇主", ["BUILDING"]


@query("month_over_month_line", "insurer:str day:str last_month_day:str head_count:long last_month_head_count:long", f"""
WITH d AS (SELECT h.insurer, h.day, sum(h.head_count) AS head_count FROM x_daily_headcount h JOIN d_policy p ON p.policy_id = h.policy_id
  JOIN d_product t ON t.product_code = p.product_code WHERE t.business_line = '{LINE}' AND p.product_code NOT IN ('{"', '".join(LEFT_OUT)}') GROUP BY 1, 2)
SELECT a.insurer, a.day, CAST(a.day - INTERVAL 1 MONTH AS DATE) AS last_month_day, a.head_count, b.head_count AS last_month_head_count
FROM d a JOIN d b ON b.insurer = a.insurer AND b.day = CAST(a.day - INTERVAL 1 MONTH AS DATE)""")
def month_over_month_line(t: Tables) -> DataFrame:
    """The report for one business line without some of its products."""
    policy = P.of_products(t.policy, t.product, LINE, LEFT_OUT)
    return R.month_over_month_headcount(P.clamped_cover(t.insured, policy, carry=("insurer",)), policy)


@query("current_insured_mart", "policy_id:long from_day:str to_day:str head_count:long holder_name:str channel_name:str team_name:str customer_type:str "
       "is_old:str sku_price:double", f"""
WITH r AS ({RUNS.format(cols="head_count", src="x_daily_headcount")}),
f AS (SELECT holder_name, min(start_date) AS first_start FROM d_policy GROUP BY 1)
SELECT r.*, p.holder_name, s.channel_name, s.team_name, CASE WHEN s.channel_name = s.ent_name THEN '直客' ELSE '渠道' END AS customer_type,
  CASE WHEN p.start_date = f.first_start THEN '新客' ELSE '老客' END AS is_old, sku_price
FROM r JOIN d_policy p ON p.policy_id = r.policy_id JOIN d_plan pl ON pl.policy_id = p.policy_id LEFT JOIN x_named_sales s ON s.ent_name = p.holder_name
LEFT JOIN f ON f.holder_name = p.holder_name""")
def current_insured_mart(t: Tables) -> DataFrame:
    mart = R.current_insured_mart(t.policy, t.plan, sellers(t), cover(t))
    keep = ["holder_name", "channel_name", "team_name", "customer_type", "is_old", "sku_price"]
    runs = equal_runs(mart.select("policy_id", "from_day", "to_day", "head_count"), ["head_count"])
    return runs.join(mart.select("policy_id", *keep).distinct(), "policy_id")


@query("month_retention", "month:str customers:long staying:long", """
WITH a AS (SELECT DISTINCT holder_id, CAST(unnest(generate_series(date_trunc('month', start_date), date_trunc('month', end_date), INTERVAL 1 MONTH)) AS DATE) AS m FROM d_policy)
SELECT strftime(a.m, '%Y%m') AS month, count(*) AS customers, count(b.m) AS staying
FROM a LEFT JOIN a b ON b.holder_id = a.holder_id AND b.m = CAST(a.m + INTERVAL 1 MONTH AS DATE) GROUP BY 1""")
def month_retention(t: Tables) -> DataFrame:
    return R.month_retention(t.policy, "holder_id")


@query("month_to_date_vs_last", "sum_premium:double last_sum_premium:double sum_premium_growth:double sum_person:double last_sum_person:double sum_person_growth:double", f"""
WITH s AS (SELECT sum(sum_premium) FILTER (day BETWEEN date_trunc('month', {TODAY}) AND {TODAY}) AS p, sum(sum_person) FILTER (day BETWEEN date_trunc('month', {TODAY}) AND {TODAY}) AS n,
  sum(sum_premium) FILTER (day BETWEEN date_trunc('month', {TODAY} - INTERVAL 1 MONTH) AND {TODAY} - INTERVAL 1 MONTH) AS lp,
  sum(sum_person) FILTER (day BETWEEN date_trunc('month', {TODAY} - INTERVAL 1 MONTH) AND {TODAY} - INTERVAL 1 MONTH) AS ln FROM x_ledger)
SELECT p AS sum_premium, lp AS last_sum_premium, round((CAST(p AS DOUBLE) - lp) / lp, 4) AS sum_premium_growth, n AS sum_person, ln AS last_sum_person,
  round((CAST(n AS DOUBLE) - ln) / ln, 4) AS sum_person_growth FROM s""")
def month_to_date_vs_last(t: Tables) -> DataFrame:
    return R.month_to_date_vs_last(ledger(t), AS_OF, ["sum_premium", "sum_person"])


@query("daily_event_counts", "kind:str day:str n:long", """
WITH d AS (SELECT CASE event_type WHEN 'view' THEN 'login' WHEN 'signup' THEN 'register' END AS kind, CAST(ts AS DATE) AS day, count(*) AS n FROM events
  WHERE event_type IN ('view', 'signup') GROUP BY 1, 2)
SELECT * FROM d UNION ALL SELECT kind, NULL, sum(n) FROM d GROUP BY 1""")
def daily_event_counts(t: Tables) -> DataFrame:
    log = t.raw("events").select(F.concat(F.lit("/users/user/"), "event_type", F.lit("?id=1")).alias("path"), F.col("ts").alias("at"))
    return R.daily_event_counts(log, {"login": "/users/user/view", "register": "/users/user/signup"})
