"""Settlement accounts and sales."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.adapters import MONEY, Tables
from coverlake.functions.text import MASK
from coverlake.operators import master as M
from coverlake.operators import settlement as S
from coverlake.oracle import CTES
from coverlake.plans.premium import ledger_wide, statistics
from coverlake.registry import query

SINCE = date(1999, 1, 1)
STORED_UNTIL = date(2000, 1, 1)
LINES = ["雇主"]
OTHER_LINES = ["场景", "健康", "体育"]

CTES["x_account_base"] = """
SELECT p.*, r.product_name, two_level, business_line, s.channel_name, s.salesman, s.team_name, s.biz_operator, s.business_source, sku_price, sku_ratio, sku_charge_type, tech_rate, broker_rate,
  CASE WHEN p.policy_id % 4 <> 0 THEN CAST((p.policy_id % 4) * CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(14,4)) END AS share,
  CASE WHEN p.policy_id % 3 = 0 THEN p.start_date + 7 ELSE p.start_date - 3 END AS created
FROM d_policy_chain p JOIN d_product r ON r.product_code = p.product_code LEFT JOIN d_plan pl ON pl.policy_id = p.policy_id
LEFT JOIN x_named_sales s ON s.ent_name = p.holder_name WHERE policy_status IN (0, 1, -1)"""
_COMMON = """product_code, product_name, channel_name, salesman AS business_owner, team_name AS business_region, business_source, biz_operator AS operator_name,
  {kind} AS business_type, {day} AS accounting_day, holder_name, sku_price AS plan_price, CAST(CASE sku_ratio WHEN '1' THEN 0.05 WHEN '2' THEN 0.1 END AS DECIMAL(6,2)) AS disability_rate,
  CASE WHEN two_level = '零工保' THEN '3' ELSE CAST(sku_charge_type AS VARCHAR) END AS pay_type, insurer, {effective} AS effective_day, {expire} AS expire_day,
  CAST(policy_status AS VARCHAR) AS policy_status, CAST({premium} AS DECIMAL(14,4)) AS premium_total, broker_rate AS economy_rate,
  CAST({premium} * broker_rate AS DECIMAL(14,4)) AS economy_fee, coalesce(tech_rate, 0) AS technical_rate, CAST({premium} * coalesce(tech_rate, CAST(0 AS DECIMAL(14,4))) AS DECIMAL(14,4)) AS technical_fee,
  coalesce(share, 0) AS brokerage_ratio, CAST({premium} * coalesce(share, CAST(0 AS DECIMAL(14,4))) AS DECIMAL(14,4)) AS brokerage_fee, {payment} AS payment"""


def _policies(lines: list[str], stored: bool = True) -> str:
    listed = ", ".join(f"'{line}'" for line in lines)
    old = f" AND start_date >= DATE '{STORED_UNTIL}'" if stored else ""
    common = _COMMON.format(kind="CASE WHEN predecessor_id IS NULL THEN '1' ELSE '2' END", day="greatest(start_date, created)", effective="start_date",
                            expire="end_date", premium="first_premium", payment="'1'")
    return f"""SELECT policy_id, policy_code, CAST(NULL AS VARCHAR) AS preserve_id, {common} FROM x_account_base
WHERE two_level IN ({listed}) AND start_date >= DATE '{SINCE}'{old}"""


CTES["x_account_change"] = """
SELECT b.* EXCLUDE (created), e.preserve_id, preserve_type, add_premium, del_premium, effective_date, j AS ps, l AS pe, b.start_date + 4 AS created,
  [1, 2, 3, 9][CAST(b.policy_id % 4 AS INTEGER) + 1] AS pay_status
FROM x_account_base b JOIN (SELECT preserve_id, policy_id, preserve_type, add_premium, del_premium, effective_date,
  CASE WHEN del_person_count <> 6 THEN effective_date END AS j, CASE WHEN del_person_count <> 7 THEN effective_date + (4 - del_person_count) END AS l
  FROM d_endorsement WHERE preserve_status = 1) e ON e.policy_id = b.policy_id"""
_PLAIN = "CASE WHEN ps IS NULL THEN CASE WHEN pe >= created THEN pe ELSE created END WHEN ps >= created THEN ps ELSE created END"
CTES["x_account_endorsements"] = f"""
SELECT DISTINCT policy_id, policy_code, preserve_id, """ + _COMMON.format(
    kind="CASE preserve_type WHEN 1 THEN '0' WHEN 2 THEN '2' WHEN 3 THEN '5' END",
    day=f"""CASE WHEN policy_status = -1 AND ps IS NOT NULL AND pe IS NOT NULL THEN CASE WHEN ps > pe THEN greatest(start_date, ps, created) ELSE {_PLAIN} END
      WHEN policy_status = -1 THEN greatest(start_date, ps, pe, created) ELSE {_PLAIN} END""",
    effective="coalesce(ps, pe, effective_date)", expire="pe", premium="(add_premium + del_premium)",
    payment="CASE pay_status WHEN 1 THEN '0' WHEN 2 THEN '1' WHEN 3 THEN '3' ELSE CAST(pay_status AS VARCHAR) END") + f"""
FROM x_account_change WHERE two_level IN ('雇主') AND coalesce(ps, pe, created) >= DATE '{SINCE}'"""
CTES["x_accounts"] = _policies(LINES, stored=False) + "\nUNION ALL SELECT * FROM x_account_endorsements"

COLUMNS = ("policy_code:str preserve_id:str product_code:str product_name:str channel_name:str business_owner:str business_region:str business_source:str "
           "operator_name:str business_type:str accounting_day:str holder_name:str plan_price:double disability_rate:double pay_type:str insurer:str "
           "effective_day:str expire_day:str policy_status:str premium_total:double economy_rate:double economy_fee:double technical_rate:double "
           "technical_fee:double brokerage_ratio:double brokerage_fee:double payment:str")


def sellers(t: Tables) -> DataFrame:
    return M.named_sales(t.sales, t.sales_team)


def plan(t: Tables) -> DataFrame:
    quarter = F.pmod("policy_id", F.lit(4))
    return t.plan.withColumn(
        "commission_discount_rate", F.when(quarter != 0, (quarter * F.lit("0.05").cast("decimal(4,2)")).cast(MONEY))
    )


def source_policies(t: Tables) -> DataFrame:
    created = F.when(F.pmod("policy_id", F.lit(3)) == 0, F.date_add("start_date", 7)).otherwise(F.date_sub("start_date", 3))
    return t.policy_chain.withColumn("created", created)


def stored_policies(t: Tables) -> DataFrame:
    """What the account table knows: the policies that started before the cut."""
    return t.policy.where(F.col("start_date") < F.lit(STORED_UNTIL)).select("policy_code", F.lit(None).cast("string").alias("preserve_id"))


def source_changes(t: Tables) -> DataFrame:
    states = F.array(F.lit(1), F.lit(2), F.lit(3), F.lit(9))
    line = F.col("del_person_count")
    policy = t.policy.select("policy_id", F.date_add("start_date", 4).alias("created"))
    return t.endorsement.join(policy, "policy_id").withColumns(
        {
            "preserve_start": F.when(line != 6, F.col("effective_date")),
            "preserve_end": F.when(line != 7, F.date_add("effective_date", F.lit(4) - line)),
            "pay_status": F.element_at(states, (F.pmod("policy_id", F.lit(4)) + 1).cast("int")),
        }
    )


def policies(t: Tables, lines: list[str], stored: DataFrame) -> DataFrame:
    return S.settlement_policies(source_policies(t), sellers(t), plan(t), t.product, stored, lines, SINCE)


def endorsements(t: Tables, stored: DataFrame) -> DataFrame:
    return S.settlement_endorsements(source_changes(t), t.policy, sellers(t), plan(t), t.product, stored, LINES, SINCE)


def accounts(t: Tables) -> DataFrame:
    nothing = stored_policies(t).where("false")
    return policies(t, LINES, nothing).unionByName(endorsements(t, nothing))


@query("settlement_policies", COLUMNS, _policies(LINES))
def settlement_policies(t: Tables) -> DataFrame:
    return policies(t, LINES, stored_policies(t))


@query("settlement_endorsements", COLUMNS, """
SELECT e.* FROM x_account_endorsements e WHERE (policy_code, preserve_id) NOT IN (SELECT 'P' || CAST(policy_id AS VARCHAR), preserve_id FROM d_endorsement WHERE preserve_type = 2)""")
def settlement_endorsements(t: Tables) -> DataFrame:
    stored = t.endorsement.where("preserve_type = 2").select(F.concat(F.lit("P"), F.col("policy_id").cast("string")).alias("policy_code"), "preserve_id")
    return endorsements(t, stored)


@query("settlement_other_lines", COLUMNS, _policies(OTHER_LINES))
def settlement_other_lines(t: Tables) -> DataFrame:
    return policies(t, OTHER_LINES, stored_policies(t))


@query("settlement_backfill", "policy_code:str preserve_id:str channel_name:str business_owner:str business_source:str operator_name:str policy_status:str premium_total:double", """
SELECT a.policy_code, a.preserve_id, coalesce(CASE WHEN a.policy_id % 2 = 0 THEN a.channel_name END, s.channel_name) AS channel_name,
  coalesce(CASE WHEN a.policy_id % 5 <> 0 THEN a.business_owner END, s.salesman) AS business_owner, coalesce(nullif(a.business_source, ''), s.business_source) AS business_source,
  coalesce(a.operator_name, s.biz_operator) AS operator_name, CAST(coalesce(p.policy_status + 10, CAST(a.policy_status AS INTEGER)) AS VARCHAR) AS policy_status, premium_total
FROM x_accounts a LEFT JOIN x_named_sales s ON s.ent_name = a.holder_name LEFT JOIN d_policy p ON p.policy_code = a.policy_code""")
def settlement_backfill(t: Tables) -> DataFrame:
    number = F.substring("policy_code", 2, 20).cast("bigint")
    gaps = accounts(t).withColumns(
        {
            "channel_name": F.when(F.pmod(number, F.lit(2)) == 0, F.col("channel_name")).otherwise(F.lit("")),
            "business_owner": F.when(F.pmod(number, F.lit(5)) != 0, F.col("business_owner")),
        }
    )
    status = t.policy.select("policy_code", (F.col("policy_status") + 10).alias("policy_status"))
    return S.settlement_backfill(gaps, sellers(t), status)


@query("settlement_sync", "policy_code:str preserve_id:str product_code:str channel_name:str accounting_day:str holder_name:str premium_total:double "
       "economy_fee:double technical_fee:double brokerage_fee:double", "SELECT * FROM x_accounts")
def settlement_sync(t: Tables) -> DataFrame:
    """The account table as it is copied between stores."""
    return accounts(t).select(
        "policy_code", "preserve_id", "product_code", "channel_name", "accounting_day", "holder_name", "premium_total", "economy_fee",
        "technical_fee", "brokerage_fee",
    )


CTES["x_other_accounts"] = _policies(OTHER_LINES, stored=False)
CTES["x_channels_ledger"] = """
WITH own AS (SELECT a.*, '雇主' AS business_line FROM x_accounts a UNION ALL SELECT a.*, two_level FROM x_other_accounts a JOIN d_product r USING (product_code)),
m AS (SELECT channel_name, min(start_date) AS first_start FROM x_policy_sales GROUP BY 1),
w AS (SELECT a.policy_code, a.product_code, a.channel_name, accounting_day, a.holder_name, premium_total, economy_fee, brokerage_fee, business_owner AS sale_name, business_line,
  coalesce(e.add_person_count - e.del_person_count, p.person_count) AS people, ar.province, ar.city, 'acount' AS source
  FROM own a LEFT JOIN d_policy p ON p.policy_code = a.policy_code LEFT JOIN d_area ar ON ar.code = substr(p.region_code, 1, 4) || '00'
  LEFT JOIN d_endorsement e ON e.preserve_id = a.preserve_id AND e.preserve_status = 1
  UNION ALL SELECT NULL, product, NULL, day, NULL, premium, CAST(premium * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(14,4)), NULL, NULL, '场景', policy_count, NULL, NULL, 'inter' FROM x_statistic
  UNION ALL SELECT 'D' || CAST(doc_id AS VARCHAR), NULL, source, DATE '2001-01-01', lang, CAST(n_chars AS DECIMAL(14,4)), NULL, NULL, NULL, '平台', NULL, NULL, NULL, 'plat' FROM documents)
SELECT w.*, first_start, CAST(first_start + INTERVAL 3 MONTH AS DATE) AS three_month, CAST(first_start + INTERVAL 6 MONTH AS DATE) AS six_month,
  CAST(first_start + INTERVAL 12 MONTH AS DATE) AS twelve_month
FROM w LEFT JOIN m ON m.channel_name = w.channel_name AND w.business_line = '雇主'"""


def channels_ledger(t: Tables) -> DataFrame:
    nothing = stored_policies(t).where("false")
    lines = t.product.select("product_code", F.col("two_level").alias("business_line"))
    own = accounts(t).withColumn("business_line", F.lit(S.EMPLOYER)).unionByName(policies(t, OTHER_LINES, nothing).join(lines, "product_code"))
    interface = statistics(t).select(
        F.col("product").alias("product_code"), F.col("day").alias("accounting_day"), F.col("premium").alias("premium_total"),
        (F.col("premium") * F.lit("0.1").cast("decimal(2,1)")).cast(MONEY).alias("economy_fee"), F.lit("场景").alias("business_line"),
        F.col("policy_count").alias("people"),
    )
    agency = t.raw("documents").select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("policy_code"), F.col("source").alias("channel_name"),
        F.lit(date(2001, 1, 1)).alias("accounting_day"), F.col("lang").alias("holder_name"), F.col("n_chars").cast(MONEY).alias("premium_total"),
        F.lit("平台").alias("business_line"),
    )
    named = t.policy.drop("channel").join(sellers(t).select("ent_name", "channel_name"), F.col("holder_name") == F.col("ent_name"), "left")
    return S.all_channels_ledger(own, interface, agency, t.policy, t.endorsement, t.area, S.channel_milestones(named))


@query("all_channels_ledger", "policy_code:str product_code:str channel_name:str accounting_day:str holder_name:str premium_total:double economy_fee:double "
       "brokerage_fee:double sale_name:str business_line:str people:long province:str city:str source:str first_start:str three_month:str "
       "six_month:str twelve_month:str", "SELECT * FROM x_channels_ledger")
def all_channels_ledger(t: Tables) -> DataFrame:
    return channels_ledger(t)


CTES["x_performance"] = f"""
WITH x AS (SELECT coalesce(l.channel_name, l.holder_name) AS channel_name, accounting_day, business_line AS category,
  CASE WHEN business_line <> '雇主' OR consumer_new_old = 'new' THEN sale_name ELSE biz_operator END AS seller, sum(premium_total) AS premium
  FROM x_channels_ledger l LEFT JOIN d_sales s ON s.ent_name = l.holder_name AND business_line = '雇主'
  WHERE l.source <> 'inter' AND accounting_day >= DATE '{STORED_UNTIL}' GROUP BY 1, 2, 3, 4)
SELECT coalesce(channel_name, '未知') AS channel_name, accounting_day, category, premium, coalesce(seller, '公司') AS salesman, department, team_name,
  CASE WHEN length(group_name) = 0 THEN seller ELSE group_name END AS sales_group
FROM x LEFT JOIN (SELECT sale_name, department, team_name, coalesce(group_name, '') AS group_name FROM d_sales_team) t ON t.sale_name = coalesce(seller, '公司')"""


def performance(t: Tables) -> DataFrame:
    team = t.sales_team.withColumn("group_name", F.coalesce("group_name", F.lit("")))
    return S.sales_performance(channels_ledger(t), t.sales, team, STORED_UNTIL)


@query("sales_performance", "channel_name:str accounting_day:str category:str premium:double salesman:str department:str team_name:str sales_group:str",
       "SELECT * FROM x_performance")
def sales_performance(t: Tables) -> DataFrame:
    return performance(t)


@query("masked_sample", "channel_name:str accounting_day:str category:str premium:double salesman:str department:str team_name:str sales_group:str", f"""
WITH h AS (SELECT *, CAST(premium * 10000 AS HUGEINT) * (CAST('0x' || substr(md5(concat_ws('|', '7', channel_name, accounting_day, category, salesman)), 1, 7) AS BIGINT) % 1000000) AS v
  FROM x_performance)
SELECT * EXCLUDE (channel_name, premium, v), sign(v) * ((abs(v) * 2 + 1000000) // 2000000) / 10000 AS premium,
  CASE WHEN length(channel_name) > 3 THEN '{MASK}' || substr(channel_name, 3) WHEN length(channel_name) >= 2 THEN '{MASK}' || substr(channel_name, 2) ELSE channel_name END AS channel_name
FROM h""")
def masked_sample(t: Tables) -> DataFrame:
    return S.masked_sample(performance(t), seed=7)


@query("sales_process", "salesman:str team_name:str group_name:str day:str policies:long endorsements:long add_premium:double del_premium:double "
       "add_person_count:long del_person_count:long sum_person:long sum_premium:double contacts:long visitors:long intended:long", """
WITH l AS (SELECT w.salesman, w.team_name, t.group_name, w.day, w.preserve_id, w.add_premium, w.del_premium, w.add_person_count, w.del_person_count, w.sum_person, w.sum_premium
  FROM x_ledger_wide w JOIN d_sales s ON s.ent_name = w.holder_name LEFT JOIN d_sales_team t ON t.sale_name = w.salesman WHERE consumer_new_old = 'new'),
d AS (SELECT salesman, team_name, group_name, day, count(*) FILTER (preserve_id IS NULL) AS policies, count(preserve_id) AS endorsements, sum(add_premium) AS add_premium,
  sum(del_premium) AS del_premium, sum(add_person_count) AS add_person_count, sum(del_person_count) AS del_person_count, sum(sum_person) AS sum_person, sum(sum_premium) AS sum_premium FROM l GROUP BY 1, 2, 3, 4),
v AS (SELECT s_name AS salesman, 'T-' || CAST(s_suppkey % 5 AS VARCHAR) AS team_name, CAST(ts AS DATE) - 8500 AS day, count(*) AS contacts,
  count(*) FILTER (event_type = 'view') AS visitors, count(*) FILTER (event_type = 'click') AS intended
  FROM events JOIN supplier ON s_suppkey = user_id % 100 GROUP BY 1, 2, 3)
SELECT coalesce(d.salesman, v.salesman) AS salesman, coalesce(d.team_name, v.team_name) AS team_name, coalesce(d.group_name, t.group_name) AS group_name, coalesce(d.day, v.day) AS day,
  coalesce(policies, 0) AS policies, coalesce(endorsements, 0) AS endorsements, coalesce(add_premium, 0) AS add_premium, coalesce(del_premium, 0) AS del_premium,
  coalesce(add_person_count, 0) AS add_person_count, coalesce(del_person_count, 0) AS del_person_count, coalesce(sum_person, 0) AS sum_person, coalesce(sum_premium, 0) AS sum_premium,
  coalesce(contacts, 0) AS contacts, coalesce(visitors, 0) AS visitors, coalesce(intended, 0) AS intended
FROM d FULL JOIN v ON d.salesman = v.salesman AND d.day = v.day LEFT JOIN d_sales_team t ON t.sale_name = coalesce(d.salesman, v.salesman)""")
def sales_process(t: Tables) -> DataFrame:
    new = t.sales.where("consumer_new_old = 'new'").select(F.col("ent_name").alias("holder_name"))
    groups = t.sales_team.select(F.col("sale_name").alias("salesman"), "group_name")
    moved = ledger_wide(t).join(new, "holder_name", "left_semi").join(groups, "salesman", "left")
    seller = t.raw("supplier").select("s_suppkey", F.col("s_name").alias("salesman"))
    visits = (
        t.raw("events").join(seller, F.pmod("user_id", F.lit(100)) == F.col("s_suppkey"))
        .select("salesman", F.concat(F.lit("T-"), F.pmod("s_suppkey", F.lit(5)).cast("string")).alias("team_name"),
                F.date_sub(F.col("ts").cast("date"), 8500).alias("day"), F.lit(1).alias("contacts"),
                (F.col("event_type") == "view").cast("int").alias("visitors"), (F.col("event_type") == "click").cast("int").alias("intended"))
    )
    return S.sales_process(moved, visits, t.sales_team)


