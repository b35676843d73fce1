"""Risk marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.adapters import AS_OF, Tables
from coverlake.operators import premium as P
from coverlake.operators import risk as R
from coverlake.oracle import CTES, TODAY, half_up
from coverlake.plans.claims import work, work_claim
from coverlake.plans.premium import ledger
from coverlake.registry import query

SINCE = date(2000, 1, 1)

CTES["x_monitor_days"] = f"""
SELECT channel, insurer, charge_type, policy_id, day FROM x_policy_day
UNION ALL
SELECT channel, insurer, charge_type, policy_id, CAST(unnest(generate_series(end_date + 1, {TODAY}, INTERVAL 1 DAY)) AS DATE)
FROM d_policy WHERE end_date < {TODAY}"""
CTES["x_monitor_day"] = """
SELECT d.channel, d.insurer, d.charge_type, d.day, sum(coalesce(h.head_count, 0)) AS head_count,
  sum(coalesce(pr.premium, 0)) AS earned_premium, sum(coalesce(l.premium, 0)) AS ledger_premium, sum(coalesce(c.cases, 0)) AS cases,
  sum(coalesce(c.settled, 0)) AS settled, sum(coalesce(c.payable, 0)) AS payable,
  sum(coalesce(ep.expired_premium, 0)) AS expired_premium, sum(coalesce(ec.expired_claims, 0)) AS expired_claims
FROM x_monitor_days d JOIN d_policy p ON d.policy_id = p.policy_id
LEFT JOIN x_daily_headcount h ON h.policy_id = d.policy_id AND h.day = d.day
LEFT JOIN x_daily_premium pr ON pr.policy_id = d.policy_id AND pr.day = d.day
LEFT JOIN (SELECT policy_id, day, sum(sum_premium) AS premium FROM x_ledger GROUP BY 1, 2) l
  ON l.policy_id = d.policy_id AND l.day = d.day AND d.day <= p.end_date
LEFT JOIN x_claim_daily c ON c.policy_id = d.policy_id AND c.day = d.day AND d.day <= p.end_date
LEFT JOIN x_expired_premium ep ON ep.policy_id = d.policy_id AND ep.day = d.day
LEFT JOIN x_expired_claims ec ON ec.policy_id = d.policy_id AND ec.day = d.day
GROUP BY 1, 2, 3, 4"""
_MEASURES = [*R.LEVELS, *R.FLOWS]
CTES["x_monitor"] = f"""
SELECT *, {", ".join(f"sum({m}) OVER (PARTITION BY channel, insurer, charge_type ORDER BY day) AS acc_{m}" for m in _MEASURES)},
  strftime(day, '%G%V') AS week_id, CASE WHEN isodow(day) = 5 THEN '星期五' END AS week_day, strftime(day, '%Y%m') AS month_id,
  CASE WHEN last_day(day) = day THEN day END AS month_end
FROM x_monitor_day"""
CTES["x_class_mix"] = """
SELECT policy_id, """ + ", ".join(
    f"count(*) FILTER (work_risk = '{i}') AS {n}_risk" for i, n in enumerate(["one", "two", "three", "four", "five", "six"], 1)
) + """, count(*) FILTER (work_name_check = '未知') AS unknown_risk, count(work_type) AS work_counts,
  count(work_type) - count(*) FILTER (work_risk IN ('1','2','3','4','5','6')) - count(*) FILTER (work_name_check = '未知') AS other_risk
FROM x_work GROUP BY policy_id"""
CTES["x_features"] = """
SELECT p.policy_id, p.predecessor_id, p.person_count, cases, payable, earned_premium, people, m.* EXCLUDE (policy_id)
FROM d_policy_chain p LEFT JOIN (SELECT policy_id, count(case_no) AS cases, sum(payable) AS payable FROM d_claim GROUP BY 1) c ON c.policy_id = p.policy_id
LEFT JOIN x_earned e ON e.policy_id = p.policy_id
LEFT JOIN (SELECT policy_id, count(cert_no) AS people FROM d_insured GROUP BY 1) i ON i.policy_id = p.policy_id
LEFT JOIN x_class_mix m ON m.policy_id = p.policy_id"""
CTES["x_exposure"] = f"""
SELECT policy_id, sum(CASE WHEN day = {TODAY} THEN head_count ELSE 0 END) AS curr_insured, sum(head_count) AS person_count
FROM x_daily_headcount WHERE day <= {TODAY} GROUP BY 1 HAVING sum(head_count) > 0"""
CTES["x_policy_sales"] = """
SELECT p.*, CASE WHEN s.channel_name = '直客' THEN s.ent_name ELSE s.channel_name END AS channel_name, salesman, biz_operator,
  consumer_new_old, business_source, ent_id
FROM d_policy p LEFT JOIN d_sales s ON p.holder_name = s.ent_name"""
CTES["x_target"] = f"""
WITH seat AS (SELECT DISTINCT holder_name AS seat, province AS channel_province, channel AS channel_city
  FROM x_policy_sales QUALIFY row_number() OVER (PARTITION BY channel_name, holder_name ORDER BY start_date DESC, policy_id DESC) = 1)
SELECT p.policy_id, p.channel_name, p.start_date, channel_province, channel_city, one_risk, two_risk, three_risk, four_risk, five_risk, six_risk,
  curr_insured, person_count_days, earned_premium, earned_since, payable, cases, dead_payable, disabled_payable, dead_cases, disabled_cases, payable_since
FROM x_policy_sales p LEFT JOIN x_class_mix m ON m.policy_id = p.policy_id LEFT JOIN seat ON seat = p.channel_name
LEFT JOIN (SELECT policy_id, curr_insured, person_count AS person_count_days FROM x_exposure) e ON e.policy_id = p.policy_id
LEFT JOIN (SELECT policy_id, sum(premium) AS earned_premium, sum(CASE WHEN day >= DATE '{SINCE}' THEN premium ELSE 0 END) AS earned_since
  FROM x_daily_premium WHERE day <= {TODAY} GROUP BY 1) d ON d.policy_id = p.policy_id
LEFT JOIN (SELECT policy_id, sum(payable) AS payable, count(case_no) AS cases, sum(CASE WHEN case_type = '死亡' THEN payable ELSE 0 END) AS dead_payable,
  sum(CASE WHEN case_type = '伤残' THEN payable ELSE 0 END) AS disabled_payable, count(*) FILTER (case_type = '死亡') AS dead_cases,
  count(*) FILTER (case_type = '伤残') AS disabled_cases, sum(CASE WHEN risk_day >= DATE '{SINCE}' THEN payable ELSE 0 END) AS payable_since
  FROM d_claim GROUP BY 1) c ON c.policy_id = p.policy_id"""


def group_cover(t: Tables) -> DataFrame:
    return P.clamped_cover(t.insured, t.policy, carry=("channel", "insurer"))


def monitor(t: Tables) -> DataFrame:
    return R.risk_monitor(t.policy, group_cover(t), ledger(t), t.claim, AS_OF)


def monitor_today(t: Tables, exposure: DataFrame | None = None, earned: DataFrame | None = None) -> DataFrame:
    return R.risk_monitor_today(t.policy, P.clamped_cover(t.insured, t.policy), ledger(t), t.claim, AS_OF, exposure, earned)


def policy_sales(t: Tables) -> DataFrame:
    """Policies with who sold them; a direct customer is its own channel."""
    s = t.sales
    named = F.when(F.col("channel_name") == P.DIRECT_CHANNEL, F.col("ent_name")).otherwise(F.col("channel_name"))
    return t.policy.join(s.withColumn("channel_name", named), F.col("holder_name") == F.col("ent_name"), "left").drop("ent_name")


def target(t: Tables) -> DataFrame:
    c = P.clamped_cover(t.insured, t.policy)
    earned = P.earned_between(c, None, AS_OF, "earned_premium").join(
        P.earned_between(c, SINCE, AS_OF, "earned_since"), "policy_id", "left"
    )
    exposure = P.exposure_to_date(c, AS_OF).withColumnRenamed("person_count", "person_count_days")
    located = policy_sales(t).withColumn("city", F.col("channel"))
    return R.target_tracking(located, work(t), exposure, earned, t.claim, SINCE)


@query("risk_monitor", "channel:str insurer:str charge_type:long day:str week_id:str week_day:str month_id:str month_end:str "
       + " ".join(f"{p}{m}:{'long' if m in ('cases', 'head_count') else 'double'}" for p in ("", "acc_") for m in _MEASURES),
       "SELECT * FROM x_monitor")
def risk_monitor(t: Tables) -> DataFrame:
    return monitor(t)


@query("risk_features", "policy_id:long person_count:long cases:long payable:double earned_premium:double people:long one_risk:long three_risk:long "
       "unknown_risk:long other_risk:long work_counts:long one_cases:long one_earned:double two_people:long three_payable:double "
       "parent_work_counts:long parent_three_risk:long", """
SELECT a.*, b.cases AS one_cases, b.earned_premium AS one_earned, c.people AS two_people, d.payable AS three_payable,
  b.work_counts AS parent_work_counts, b.three_risk AS parent_three_risk
FROM x_features a LEFT JOIN x_features b ON b.policy_id = a.predecessor_id LEFT JOIN x_features c ON c.policy_id = b.predecessor_id
LEFT JOIN x_features d ON d.policy_id = c.predecessor_id""")
def risk_features(t: Tables) -> DataFrame:
    earned = P.earned_to_date(P.clamped_cover(t.insured, t.policy), t.policy, AS_OF)
    return R.risk_features(t.policy_chain, work(t), t.claim, earned, t.insured)


TARGET_COLUMNS = ("policy_id:long channel_name:str channel_province:str channel_city:str one_risk:long two_risk:long three_risk:long four_risk:long "
                  "five_risk:long six_risk:long curr_insured:long person_count_days:long earned_premium:double earned_since:double "
                  "payable:double cases:long dead_payable:double disabled_payable:double dead_cases:long disabled_cases:long payable_since:double")


@query("target_tracking", TARGET_COLUMNS, "SELECT * FROM x_target")
def target_tracking(t: Tables) -> DataFrame:
    return target(t)


@query("target_tracking_channels", "channel_name:str first_day:str loss_class:str mature:str customer_kind:str", f"""
SELECT channel_name, min(start_date) AS first_day,
  CASE WHEN coalesce(sum(payable), 0) / sum(earned_premium) <= 0.7 THEN 'A' WHEN coalesce(sum(payable), 0) / sum(earned_premium) <= 1.3 THEN 'B' ELSE 'C' END AS loss_class,
  CASE WHEN min(start_date) <= {TODAY} - INTERVAL 6 MONTH THEN '是' ELSE '否' END AS mature,
  CASE WHEN min(start_date) >= DATE '{SINCE}' THEN '新客' ELSE '老客' END AS customer_kind
FROM x_target WHERE earned_premium > 0 GROUP BY 1""")
def target_tracking_channels(t: Tables) -> DataFrame:
    return R.target_channels(target(t), AS_OF, SINCE)


@query("target_tracking_months", "channel:str ten_day:str month:str earned:double payable:double", """
SELECT p.channel, strftime(d.day, '%Y') || '-T' || lpad(CAST((month(d.day) - 1) * 3 + least((day(d.day) - 1) // 10, 2) + 1 AS VARCHAR), 2, '0') AS ten_day,
  strftime(d.day, '%Y%m') AS month, sum(premium) AS earned, sum(c.payable) AS payable
FROM x_daily_premium d JOIN d_policy p ON p.policy_id = d.policy_id
LEFT JOIN x_claim_daily c ON c.policy_id = d.policy_id AND c.day = d.day GROUP BY 1, 2, 3""")
def target_tracking_months(t: Tables) -> DataFrame:
    return R.target_months(group_cover(t), t.claim, "channel")


_SHARES = ["one_rate", "two_rate", "three_rate", "four_rate", "five_rate", "six_rate", "man_rate", "woman_rate",
           "under_16", "under_25", "under_36", "under_45", "under_55", "over_55"]
_GS = "nullif(CAST(count(*) FILTER (gs_work_risk >= 0) AS DOUBLE), 0)"
_SEX = "nullif(CAST(count(*) FILTER (gender IN (0, 1)) AS DOUBLE), 0)"
_BANDS = ["age > 0 AND age < 16", "age >= 16 AND age < 25", "age >= 25 AND age < 36", "age >= 36 AND age < 45", "age >= 45 AND age < 55", "age >= 55"]
_SHARE_SQL = (
    [f"count(*) FILTER (gs_work_risk = {i + 1}) / {_GS} AS {n}" for i, n in enumerate(_SHARES[:5])]
    + [f"count(*) FILTER (gs_work_risk IN (0, 6)) / {_GS} AS six_rate"]
    + [f"count(*) FILTER (gender = 1) / {_SEX} AS man_rate", f"count(*) FILTER (gender = 0) / {_SEX} AS woman_rate"]
    + [f"count(*) FILTER ({c}) / nullif(CAST(count(cert_no) AS DOUBLE), 0) AS {n}" for n, c in zip(_SHARES[8:], _BANDS)]
)


@query("claim_analysis", "policy_id:long month_price:double first_policy:str channel_kind:str cases:long payable:double curr_insured:long "
       "person_days:long earned_premium:double " + " ".join(f"{s}:double" for s in _SHARES), f"""
SELECT p.policy_id, CASE WHEN charge_type = 2 THEN {half_up('price', '12')} ELSE price END AS month_price,
  CASE WHEN row_number() OVER (PARTITION BY holder_name ORDER BY start_date, p.policy_id) = 1 THEN '1' END AS first_policy,
  CASE WHEN min(start_date) OVER (PARTITION BY channel) >= DATE '{SINCE}' THEN '新客' ELSE '老客' END AS channel_kind,
  cases, payable, curr_insured, e.person_count AS person_days, earned_premium, {", ".join(f"round({s}, 6) AS {s}" for s in _SHARES)}
FROM d_policy p LEFT JOIN (SELECT policy_id, {", ".join(_SHARE_SQL)} FROM x_work GROUP BY 1) s ON s.policy_id = p.policy_id
LEFT JOIN (SELECT policy_id, count(case_no) AS cases, sum(payable) AS payable FROM d_claim GROUP BY 1) c ON c.policy_id = p.policy_id
LEFT JOIN x_exposure e ON e.policy_id = p.policy_id
LEFT JOIN (SELECT policy_id, sum(premium) AS earned_premium FROM x_daily_premium WHERE day <= {TODAY} GROUP BY 1) d ON d.policy_id = p.policy_id""")
def claim_analysis(t: Tables) -> DataFrame:
    c = P.clamped_cover(t.insured, t.policy)
    exposure = P.exposure_to_date(c, AS_OF).withColumnRenamed("person_count", "person_days")
    earned = P.earned_between(c, None, AS_OF, "earned_premium")
    result = R.claim_analysis(t.policy, work(t), t.claim, exposure, earned, SINCE)
    return result.withColumns({s: F.round(s, 6) for s in _SHARES})


@query("claim_and_plan_mart", "case_no:str policy_id:long risk_cert_no:str risk_day:str payable:double work_type:str", """
SELECT c.case_no, c.policy_id, c.risk_cert_no, c.risk_day, c.payable, w.work_type FROM d_claim c
LEFT JOIN (SELECT policy_id, cert_no, work_type FROM d_insured_work
           QUALIFY row_number() OVER (PARTITION BY policy_id, cert_no ORDER BY start_date DESC NULLS LAST, insured_id DESC) = 1) w
  ON w.policy_id = c.policy_id AND w.cert_no = c.risk_cert_no
WHERE c.policy_id IN (SELECT policy_id FROM d_insured)""")
def claim_and_plan_mart(t: Tables) -> DataFrame:
    return R.claim_list(t.claim, t.insured_work)


@query("plan_work_type_share", "channel:str insurer:str profession_type:str charge:str coverage:str ratio:str month_price:double work_type:str "
       "risk_name:str curr_insured:long payable:double earned:double all_curr_insured:long", f"""
SELECT *, sum(curr_insured) OVER (PARTITION BY channel) AS all_curr_insured FROM (
SELECT channel, insurer, profession_type, CASE p.charge_type WHEN 1 THEN '月单' WHEN 2 THEN '年单' ELSE '其他' END AS charge,
  CAST(CAST(sku_coverage AS DECIMAL(14,0)) AS VARCHAR) || '万' AS coverage, CASE sku_ratio WHEN '1' THEN '5%' WHEN '2' THEN '10%' END AS ratio,
  CASE WHEN p.charge_type = 2 THEN {half_up('p.price', '12')} ELSE p.price END AS month_price, work_type,
  CASE WHEN work_risk IS NOT NULL THEN ['一类','二类','三类','四类','五类','六类','七类'][CAST(work_risk AS INTEGER)] END AS risk_name,
  count(*) FILTER ({TODAY} BETWEEN w.start_date AND w.end_date) AS curr_insured, sum(payable) AS payable, sum(coalesce(earned, 0)) AS earned
FROM x_work_claim w JOIN d_policy p ON p.policy_id = w.policy_id JOIN d_plan pl ON pl.policy_id = p.policy_id
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9)""")
def plan_work_type_share(t: Tables) -> DataFrame:
    plans = t.plan.select("policy_id", "sku_coverage", "sku_ratio")
    policy = t.policy.select("policy_id", "channel", "insurer", "charge_type", "price")
    return R.plan_work_type(work_claim(t, policy, plans), AS_OF)


@query("channel_overlap", "channel:str biz_operator:str salesman:str overlap:double curr_insured:long loss_rate:double risk_rate:double list_flag:long", f"""
WITH seen AS (SELECT DISTINCT cert_no, channel_name AS channel, biz_operator, salesman
  FROM d_insured i JOIN x_policy_sales p ON p.policy_id = i.policy_id WHERE channel_name IS NOT NULL),
multi AS (SELECT cert_no FROM seen GROUP BY 1 HAVING count(DISTINCT channel) > 1),
today AS (SELECT channel, sum(head_count) AS curr_insured, coalesce(CAST(sum(acc_payable) AS DOUBLE) / nullif(CAST(sum(acc_earned_premium) AS DOUBLE), 0), 0) AS loss_rate,
  CAST(sum(acc_cases) * 365 AS DOUBLE) / nullif(CAST(sum(acc_head_count) AS DOUBLE), 0) AS risk_rate FROM x_monitor WHERE day = {TODAY} GROUP BY 1)
SELECT s.channel, s.biz_operator, s.salesman, round(overlap, 6) AS overlap, curr_insured, round(loss_rate, 6) AS loss_rate, round(risk_rate, 6) AS risk_rate,
  coalesce(colour, 0) AS list_flag
FROM (SELECT channel, biz_operator, salesman, count(*) FILTER (cert_no IN (SELECT cert_no FROM multi)) / CAST(count(*) AS DOUBLE) AS overlap
      FROM seen GROUP BY 1, 2, 3) s
LEFT JOIN today t ON t.channel = s.channel LEFT JOIN d_watch_list w ON w.ent_name = s.channel""")
def channel_overlap(t: Tables) -> DataFrame:
    sellers = policy_sales(t).select("policy_id", F.col("channel_name").alias("channel"), "biz_operator", "salesman")
    people = t.insured.join(sellers, "policy_id")
    out = R.channel_overlap(people, monitor_today(t), t.watch_list)
    return out.withColumns({c: F.round(c, 6) for c in ("overlap", "loss_rate", "risk_rate")})


# Fixed values of the test tables: monthly reference price by work class.
REFERENCE_PRICES = [(1, "800.0000"), (2, "1200.0000"), (3, "2000.0000"), (4, "3500.0000"), (5, "5200.5000"), (6, "9000.2500")]
CTES["x_reference"] = "SELECT work_class, CAST(avg_price AS DECIMAL(14,4)) AS avg_price FROM (VALUES " + ", ".join(
    f"({c}, {p})" for c, p in REFERENCE_PRICES) + ") t(work_class, avg_price)"


@query("supplement_premium", "policy_id:long supplement_premium:double", f"""
WITH base AS (SELECT c.*, w.grade_high, w.gs_work_risk AS work_class, CASE WHEN c.charge_type = 2 THEN avg_price * 12 ELSE avg_price END AS reference
  FROM x_cover c JOIN (SELECT DISTINCT insured_id, grade_high, gs_work_risk FROM x_work) w ON w.insured_id = c.insured_id
  LEFT JOIN x_reference r ON r.work_class = w.gs_work_risk),
short AS (SELECT *, CAST(CASE WHEN work_class > grade_high AND reference > price THEN reference - price ELSE 0 END AS DECIMAL(14,4)) AS shortfall FROM base),
priced AS (SELECT *, {half_up('shortfall', "(CASE WHEN charge_type = 2 THEN datediff('day', policy_start, policy_end) + 1 ELSE datediff('day', cover_start, cover_end) + 1 END)")} AS p FROM short)
SELECT policy_id, sum(p) AS supplement_premium FROM (SELECT policy_id, p, unnest(generate_series(cover_start, cover_end, INTERVAL 1 DAY)) AS day FROM priced)
WHERE day <= {TODAY} GROUP BY 1""")
def supplement_premium(t: Tables) -> DataFrame:
    from coverlake.sources.literal import literal_table

    prices = literal_table(t.spark, ["work_class", "avg_price"], REFERENCE_PRICES).withColumn("avg_price", F.col("avg_price").cast(P.MONEY))
    people = work(t).withColumnRenamed("gs_work_risk", "work_class")
    return P.supplement_premium(people, t.policy, prices, AS_OF)


@query("mart_copy", "policy_id:long work_type:str people:long known:long", """
SELECT policy_id, work_type, count(*) AS people, count(*) FILTER (plan_recognition = '已知') AS known FROM x_work GROUP BY 1, 2""")
def mart_copy(t: Tables) -> DataFrame:
    return work(t).groupBy("policy_id", "work_type").agg(
        F.count(F.lit(1)).alias("people"), F.count_if(F.col("plan_recognition") == "已知").alias("known")
    )


