"""Premium and exposure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.adapters import AS_OF, Tables
from coverlake.functions.dates import day_id
from coverlake.operators import premium as P
from coverlake.oracle import CTES, TODAY, half_up
from coverlake.registry import query

CTES["x_cover"] = """
SELECT i.policy_id, insured_id, person_id, cert_no, p.start_date AS policy_start, p.end_date AS policy_end, charge_type, price,
  greatest(coalesce(i.start_date, i.end_date), p.start_date) AS cover_start,
  least(coalesce(i.end_date, i.start_date), p.end_date) AS cover_end
FROM d_insured i JOIN d_policy p ON i.policy_id = p.policy_id
WHERE greatest(coalesce(i.start_date, i.end_date), p.start_date) <= least(coalesce(i.end_date, i.start_date), p.end_date)"""
CTES["x_priced"] = f"""
SELECT *, {half_up('price', "(CASE WHEN charge_type = 2 THEN datediff('day', policy_start, policy_end) + 1 ELSE datediff('day', cover_start, cover_end) + 1 END)")} AS day_price
FROM x_cover"""
CTES["x_person_day"] = """
SELECT policy_id, insured_id, cert_no, charge_type, day_price,
  CAST(unnest(generate_series(cover_start, cover_end, INTERVAL 1 DAY)) AS DATE) AS day
FROM x_priced"""
CTES["x_daily_premium"] = "SELECT policy_id, day, sum(day_price) AS premium FROM x_person_day GROUP BY policy_id, day"
CTES["x_policy_day"] = """
SELECT policy_id, channel, insurer, charge_type, holder_name,
  CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS day FROM d_policy"""
CTES["x_daily_headcount"] = """
SELECT pd.policy_id, pd.day, any_value(channel) AS channel, any_value(insurer) AS insurer, any_value(pd.charge_type) AS charge_type,
  any_value(holder_name) AS holder_name, count(DISTINCT cert_no) AS head_count
FROM x_policy_day pd LEFT JOIN x_person_day x ON pd.policy_id = x.policy_id AND pd.day = x.day
GROUP BY pd.policy_id, pd.day"""
CTES["x_earned"] = f"""
SELECT p.policy_id, coalesce(sum(premium), 0) AS earned_premium
FROM d_policy p LEFT JOIN x_daily_premium d ON p.policy_id = d.policy_id AND d.day < {TODAY} GROUP BY p.policy_id"""
CTES["x_ledger"] = """
SELECT policy_id, CASE WHEN predecessor_id IS NOT NULL THEN CAST(predecessor_id AS VARCHAR) END AS preserve_id,
  CASE WHEN predecessor_id IS NULL THEN 4 ELSE 2 END AS premium_type, first_premium AS add_premium,
  person_count AS add_person_count, CAST(0 AS DECIMAL(14,4)) AS del_premium, 0 AS del_person_count, start_date AS day,
  person_count AS sum_person, first_premium AS sum_premium
FROM d_policy_chain WHERE policy_status IN (0, 1, -1)
UNION ALL
SELECT e.policy_id, preserve_id, preserve_type, add_premium, add_person_count, del_premium, del_person_count, effective_date,
  add_person_count - del_person_count, add_premium + del_premium
FROM d_endorsement e JOIN d_policy p ON e.policy_id = p.policy_id
WHERE (preserve_status = 1 AND preserve_type IN (1, 2)) OR preserve_type = 3"""
CTES["x_ledger_wide"] = """
SELECT DISTINCT l.*, p.holder_name, p.product_code, sku_price, sku_ratio,
  CASE WHEN s.channel_name = '直客' THEN s.ent_name ELSE s.channel_name END AS channel_name, s.salesman, team_name,
  one_level, two_level, business_line
FROM x_ledger l JOIN d_policy p ON l.policy_id = p.policy_id LEFT JOIN d_plan pl ON pl.policy_id = p.policy_id
LEFT JOIN d_sales s ON s.ent_name = p.holder_name LEFT JOIN d_sales_team st ON st.sale_name = s.salesman
LEFT JOIN d_product pr ON pr.product_code = p.product_code"""
CTES["x_statistic"] = """
SELECT event_id AS id, event_type AS product, CAST(ts AS DATE) AS day, 4 AS premium_type,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS policy_count, CAST(value AS DECIMAL(14,4)) AS premium
FROM events"""
CTES["x_latest_statistic"] = """
SELECT * FROM x_statistic QUALIFY row_number() OVER (PARTITION BY product, day ORDER BY id DESC) = 1"""
# Runs of equal neighbouring days, the form daily facts are compared in.
RUNS = """
SELECT policy_id, min(day) AS from_day, max(day) AS to_day, {cols}
FROM (SELECT *, day - CAST(row_number() OVER (PARTITION BY policy_id, {cols} ORDER BY day) AS INTEGER) AS island FROM {src})
GROUP BY policy_id, island, {cols}"""


def cover(t: Tables) -> DataFrame:
    return P.clamped_cover(t.insured, t.policy)


def ledger(t: Tables) -> DataFrame:
    chain = t.policy_chain.withColumn("predecessor", F.col("predecessor_id").cast("string"))
    return P.premium_ledger(chain, t.endorsement)


def ledger_wide(t: Tables) -> DataFrame:
    return P.ledger_enrich(ledger(t), t.policy, t.plan, t.sales, t.sales_team, t.product)


def statistics(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return t.raw("events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("product"),
        F.col("ts").cast("date").alias("day"),
        F.lit(4).alias("premium_type"),
        k.alias("policy_count"),
        F.col("value").cast(P.MONEY).alias("premium"),
    )


def equal_runs(runs: DataFrame, values: list[str]) -> DataFrame:
    """Joins neighbouring runs with equal values. A policy has at most one run per day, so the window is bounded."""
    from pyspark.sql import Window

    w = Window.partitionBy("policy_id").orderBy("from_day")
    same = F.lag("to_day").over(w) == F.date_sub("from_day", 1)
    for v in values:
        same = same & F.lag(v).over(w).eqNullSafe(F.col(v))
    island = F.sum(F.when(same, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        runs.withColumn("island", island)
        .groupBy("policy_id", "island", *values)
        .agg(F.min("from_day").alias("from_day"), F.max("to_day").alias("to_day"))
    )


@query("premium_ledger", "policy_id:long preserve_id:str premium_type:long add_premium:double add_person_count:long "
       "del_premium:double del_person_count:long sum_person:long sum_premium:double day:str", "SELECT * FROM x_ledger")
def premium_ledger(t: Tables) -> DataFrame:
    return ledger(t)


@query("ledger_enrich", "policy_id:long preserve_id:str premium_type:long sum_premium:double day:str holder_name:str sku_price:double "
       "sku_ratio:str channel_name:str salesman:str team_name:str one_level:str business_line:str", "SELECT * FROM x_ledger_wide")
def ledger_enrich(t: Tables) -> DataFrame:
    return ledger_wide(t)


PRICE_SQL = "SELECT policy_id, insured_id, strftime(day, '%Y%m%d') AS day_id, day_price FROM x_person_day WHERE charge_type = {}"


@query("daily_price_annual", "policy_id:long insured_id:str day_id:str day_price:double", PRICE_SQL.format(2))
def daily_price_annual(t: Tables) -> DataFrame:
    return P.daily_price(cover(t), P.ANNUAL).withColumn("day_id", day_id(F.col("day")))


@query("daily_price_monthly", "policy_id:long insured_id:str day_id:str day_price:double", PRICE_SQL.format(1))
def daily_price_monthly(t: Tables) -> DataFrame:
    return P.daily_price(cover(t), P.MONTHLY).withColumn("day_id", day_id(F.col("day")))


@query("daily_premium", "policy_id:long day_id:str premium:double",
       "SELECT policy_id, strftime(day, '%Y%m%d') AS day_id, premium FROM x_daily_premium")
def daily_premium(t: Tables) -> DataFrame:
    return P.daily_premium(cover(t)).withColumn("day_id", day_id(F.col("day")))


@query("daily_premium_segments", "policy_id:long from_day:str to_day:str premium:double",
       RUNS.format(cols="premium", src="x_daily_premium"))
def daily_premium_segments(t: Tables) -> DataFrame:
    return equal_runs(P.daily_premium_runs(cover(t)), ["premium"])


@query("daily_headcount", "policy_id:long from_day:str to_day:str head_count:long",
       RUNS.format(cols="head_count", src="x_daily_headcount"))
def daily_headcount(t: Tables) -> DataFrame:
    return equal_runs(P.daily_headcount_runs(cover(t), t.policy), ["head_count"])


@query("insured_premium_day_join", "policy_id:long from_day:str to_day:str head_count:long premium:double", RUNS.format(
    cols="head_count, premium",
    src="(SELECT h.policy_id, h.day, head_count, premium FROM x_daily_headcount h "
        "LEFT JOIN x_daily_premium p ON h.policy_id = p.policy_id AND h.day = p.day)"))
def insured_premium_day_join(t: Tables) -> DataFrame:
    return equal_runs(P.insured_premium_runs(cover(t), t.policy), ["head_count", "premium"])


@query("person_days", "policy_id:long person_days:long", f"""
SELECT policy_id, sum(CASE WHEN s <= least(e, {TODAY}) THEN datediff('day', s, least(e, {TODAY})) + 1 ELSE 0 END) AS person_days
FROM (SELECT policy_id, coalesce(start_date, end_date) AS s, coalesce(end_date, start_date) AS e FROM d_insured)
GROUP BY policy_id""")
def person_days(t: Tables) -> DataFrame:
    return P.person_days(t.insured, AS_OF)


@query("earned_to_date", "policy_id:long holder_name:str earned_premium:double",
       "SELECT p.policy_id, holder_name, earned_premium FROM d_policy p JOIN x_earned e ON p.policy_id = e.policy_id")
def earned_to_date(t: Tables) -> DataFrame:
    return P.earned_to_date(cover(t), t.policy, AS_OF)


@query("current_month_summary", "insurer:str charge:str consumer_new_old:str head_count:long premium:double", f"""
SELECT insurer, CASE WHEN charge_type = 1 THEN '月单' ELSE '年单' END AS charge, coalesce(s.consumer_new_old, 'old') AS consumer_new_old,
  sum(CASE WHEN two_level = '零工保' THEN 0 ELSE coalesce(head_count, 0) END) AS head_count, sum(coalesce(premium, 0)) AS premium
FROM d_policy p LEFT JOIN d_sales s ON p.holder_name = s.ent_name LEFT JOIN d_product pr ON pr.product_code = p.product_code
LEFT JOIN (SELECT policy_id, head_count FROM x_daily_headcount WHERE day = {TODAY}) h ON h.policy_id = p.policy_id
LEFT JOIN (SELECT policy_id, sum(sum_premium) AS premium FROM x_ledger
           WHERE day BETWEEN date_trunc('month', {TODAY}) AND {TODAY} GROUP BY policy_id) a ON a.policy_id = p.policy_id
GROUP BY 1, 2, 3""")
def current_month_summary(t: Tables) -> DataFrame:
    base = t.policy.join(t.sales.select("ent_name", "consumer_new_old"), F.col("holder_name") == F.col("ent_name"), "left")
    base = base.join(t.product.select("product_code", "two_level"), "product_code", "left")
    live = cover(t).where(F.lit(AS_OF).between(F.col("cover_start"), F.col("cover_end")))
    today = live.groupBy("policy_id").agg(F.countDistinct("cert_no").alias("head_count"))
    booked = ledger(t).select("policy_id", "day", F.col("sum_premium").alias("premium"))
    return P.current_month_summary(base, today, booked, AS_OF)


@query("latest_statistic_per_day", "product:str day:str id:long policy_count:long premium:double", "SELECT * FROM x_latest_statistic")
def latest_statistic_per_day(t: Tables) -> DataFrame:
    return P.latest_statistic_per_day(statistics(t))


@query("product_day_premium", "line:str day:str premium_type:long policy_count:long premium:double source:str", """
SELECT one_level AS line, day, premium_type, count(*) AS policy_count, sum(sum_premium) AS premium, '官网' AS source
FROM x_ledger_wide GROUP BY 1, 2, 3
UNION ALL
SELECT product, day, premium_type, sum(policy_count), sum(premium), '接口' FROM x_latest_statistic GROUP BY 1, 2, 3""")
def product_day_premium(t: Tables) -> DataFrame:
    return P.product_day_premium(ledger_wide(t), P.latest_statistic_per_day(statistics(t)))


@query("peak_and_cumulative_headcount", "holder_name:str channel:str holder_peak:long channel_peak:long cumulative:long earned_premium:double", f"""
WITH hd AS (SELECT * FROM x_daily_headcount WHERE day <= {TODAY} AND head_count > 0),
h AS (SELECT holder_name, max(n) AS holder_peak, sum(n) AS cumulative FROM
      (SELECT holder_name, day, sum(head_count) AS n FROM hd GROUP BY 1, 2) GROUP BY 1),
c AS (SELECT channel, max(n) AS channel_peak FROM (SELECT channel, day, sum(head_count) AS n FROM hd GROUP BY 1, 2) GROUP BY 1),
e AS (SELECT holder_name, channel, sum(earned_premium) AS earned_premium FROM d_policy p JOIN x_earned x ON p.policy_id = x.policy_id GROUP BY 1, 2)
SELECT e.holder_name, e.channel, holder_peak, channel_peak, cumulative, earned_premium
FROM e LEFT JOIN h ON h.holder_name = e.holder_name LEFT JOIN c ON c.channel = e.channel""")
def peak_and_cumulative_headcount(t: Tables) -> DataFrame:
    return P.peak_and_cumulative_headcount(cover(t), t.policy, AS_OF)
