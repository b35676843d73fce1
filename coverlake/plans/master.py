"""Conformed master data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.adapters import AS_OF, MONEY, Tables
from coverlake.operators import master as M
from coverlake.oracle import CTES, TODAY, age_sql
from coverlake.registry import query
from coverlake.sources.literal import literal_table

LINE = "蓝领外包"

# Fixed values of the test tables: product rates and products with a fixed broker rate.
PRODUCT_RATES = [("AUTOMOBILE", "0.0500", "0.0700"), ("BUILDING", "0.0600", "0.0800"), ("FURNITURE", "0.0300", "0.0200")]
FIXED_RATES = {"HOUSEHOLD": "0.1", "MACHINERY": "0.2"}

_SPLIT = "start_date >= DATE '1998-01-01'"

CTES["x_source_policy"] = """
SELECT *, 'N' || CAST(policy_id AS VARCHAR) AS policy_no,
  CASE WHEN predecessor_id IS NOT NULL THEN 'N' || CAST(predecessor_id AS VARCHAR) END AS continued_policy_no,
  CASE WHEN policy_status = 1 THEN 1 WHEN policy_status = 0 THEN 4 WHEN insurer = '5-LOW' THEN 2 ELSE -1 END AS status,
  CASE WHEN balance >= 0 THEN holder_name END AS holder_on_file,
  CASE WHEN person_count <= 5 THEN price END AS paid_premium, CASE WHEN person_count <= 10 THEN first_premium END AS known_premium,
  substr(coalesce(region_code, ''), 1, 6) AS code
FROM d_policy_chain"""


def source_policy(t: Tables) -> DataFrame:
    """Policies as the two source systems would send them."""
    p = F.col("predecessor_id")
    return t.policy_chain.withColumns(
        {
            "policy_no": F.concat(F.lit("N"), F.col("policy_id").cast("string")),
            "continued_policy_no": F.when(p.isNotNull(), F.concat(F.lit("N"), p.cast("string"))),
            "status": F.when(F.col("policy_status") == 1, 1).when(F.col("policy_status") == 0, 4).when(F.col("insurer") == "5-LOW", 2).otherwise(-1),
            "holder_on_file": F.when(F.col("balance") >= 0, F.col("holder_name")),
            "paid_premium": F.when(F.col("person_count") <= 5, F.col("price")),
            "sum_premium": F.col("first_premium"),
            "first_premium": F.when(F.col("person_count") <= 10, F.col("first_premium")),
            "province_code": F.coalesce("region_code", F.lit("")),
            "city_code": F.coalesce("region_code", F.lit("")),
            "county_code": F.coalesce("region_code", F.lit("")),
        }
    )


@query("policy_conform", "policy_id:long policy_code:str preserve_policy_no:str policy_status:long holder_name:str belongs_regional:str "
       "first_premium:double source_system:str", f"""
WITH s AS (SELECT *, CASE WHEN status = 1 AND end_date > {TODAY} THEN 1 WHEN status = 4 OR (status = 1 AND end_date < {TODAY}) THEN 0 WHEN status = -1 THEN -1 ELSE 99 END AS state,
  CASE WHEN length(code) = 6 THEN code END AS region FROM x_source_policy)
SELECT policy_id, policy_code, 'P' || CAST(predecessor_id AS VARCHAR) AS preserve_policy_no, state AS policy_status, holder_name,
  region AS belongs_regional, coalesce(paid_premium, known_premium, first_premium) AS first_premium, '1.0' AS source_system FROM s WHERE NOT ({_SPLIT})
UNION ALL
SELECT s.policy_id, s.policy_code, n.policy_code, state, s.holder_name, region, coalesce(paid_premium, known_premium, first_premium), '2.0'
FROM s LEFT JOIN (SELECT policy_no, policy_code FROM x_source_policy WHERE {_SPLIT}) n ON n.policy_no = s.continued_policy_no WHERE {_SPLIT}""")
def policy_conform(t: Tables) -> DataFrame:
    source = source_policy(t)
    second = F.col("start_date") >= F.lit("1998-01-01").cast("date")
    p = F.col("predecessor_id")
    one = source.where(~second).withColumn("preserve_policy_no", F.when(p.isNotNull(), F.concat(F.lit("P "), p.cast("string"))))
    one = one.withColumn("belongs_regional", F.col("region_code"))
    return M.policy_conform(one, source.where(second), AS_OF)


def source_people(t: Tables) -> DataFrame:
    """Insured people as the source systems would send them: line feeds, blanks, Latin letters among the names."""
    return t.insured.select(
        "insured_id", "policy_id",
        F.concat(F.lit("员工\n"), F.col("person_id").cast("string"), F.lit(" 号")).alias("name"),
        F.when(F.pmod("workplace_id", F.lit(3)) == 0, None).otherwise(F.concat(F.lit("W 装配"), F.col("workplace_id").cast("string"))).alias("work_type"),
        F.when(F.length("cert_no") == 18, "1").otherwise("2").alias("cert_type"),
        F.concat(F.col("cert_no"), F.lit("\n")).alias("cert_no"),
        F.when(F.pmod("workplace_id", F.lit(7)) == 0, "NULL").otherwise(F.col("mobile")).alias("mobile"),
        (F.pmod("person_id", F.lit(3))).cast("int").alias("sex"),
        "start_date", "end_date",
        F.when(F.col("workplace_id") > 3, F.concat(F.lit("U"), F.col("workplace_id").cast("string"))).alias("user_id"),
    )


@query("insured_conform", "insured_id:str policy_id:long insured_name:str work_type:str cert_type:long cert_no:str mobile:str gender:long age:long", f"""
SELECT insured_id, policy_id, '员工号' AS insured_name, CASE WHEN workplace_id % 3 <> 0 THEN '装配' END AS work_type,
  CASE WHEN length(cert_no) = 18 THEN 1 ELSE -1 END AS cert_type, cert_no, CASE WHEN workplace_id % 7 <> 0 THEN mobile END AS mobile,
  CASE person_id % 3 WHEN 2 THEN 0 WHEN 1 THEN 1 END AS gender,
  CASE WHEN length(cert_no) = 18 AND start_date IS NOT NULL THEN {age_sql('cert_no', 'start_date')} END AS age
FROM d_insured WHERE start_date IS NULL OR start_date >= DATE '1998-01-01' OR workplace_id NOT IN (4, 14)""")
def insured_conform(t: Tables) -> DataFrame:
    people = source_people(t)
    second = F.col("start_date").isNull() | (F.col("start_date") >= F.lit("1998-01-01").cast("date"))
    return M.insured_conform(people.where(~second), people.where(second), ["U4", "U14"])


@query("dependant_conform", "master_id:str slave_name:str slave_cert_type:long slave_cert_no:str", """
SELECT master_id, slave_name, CASE WHEN length(slave_cert_no) = 18 THEN 1 ELSE -1 END AS slave_cert_type, slave_cert_no FROM d_dependant""")
def dependant_conform(t: Tables) -> DataFrame:
    rows = t.dependant.select(
        "master_id", F.concat(F.col("slave_name"), F.lit(" \n")).alias("name"),
        F.when(F.length("slave_cert_no") == 18, "1").otherwise("9").alias("cert_type"), F.col("slave_cert_no").alias("cert_no"),
    )
    return M.dependant_conform(rows)


@query("holder_conform", "policy_id:long holder_name:str holder_cert_type:long holder_cert_no:str gender:long mobile:str", """
SELECT policy_id, replace(holder_name, ' ', '') AS holder_name, CASE WHEN length(holder_cert_no) = 18 THEN 1 ELSE -1 END AS holder_cert_type,
  holder_cert_no, CASE WHEN holder_id % 3 = 2 THEN 0 ELSE 1 END AS gender, holder_mobile AS mobile FROM d_policy""")
def holder_conform(t: Tables) -> DataFrame:
    rows = t.policy.select(
        "policy_id", F.col("holder_name").alias("name"), F.when(F.length("holder_cert_no") == 18, 1).otherwise(3).alias("cert_type"),
        F.col("holder_cert_no").alias("cert_no"), F.pmod("holder_id", F.lit(3)).cast("int").alias("sex"), F.col("holder_mobile").alias("mobile"), "start_date",
    )
    one = rows.where("start_date <= date '1999-01-01'").drop("start_date")
    return M.holder_conform(one, rows.where("start_date >= date '1998-06-01'").drop("start_date"))


@query("enterprise_conform", "ent_id:str ent_name:str license:str address:str updated:str system:long", """
SELECT md5(holder_name) AS ent_id, holder_name AS ent_name, policy_code AS license, channel AS address, start_date AS updated,
  CASE WHEN start_date >= DATE '1998-01-01' THEN 2 ELSE 1 END AS system FROM d_policy
QUALIFY row_number() OVER (PARTITION BY holder_name ORDER BY start_date DESC, policy_id DESC) = 1""")
def enterprise_conform(t: Tables) -> DataFrame:
    rows = t.policy.select(
        F.concat(F.col("holder_name"), F.lit(" ")).alias("ent_name"), F.col("policy_code").alias("license"), F.col("channel").alias("address"),
        F.col("start_date").alias("updated"), F.col("policy_id").alias("record_id"),
    )
    second = F.col("updated") >= F.lit("1998-01-01").cast("date")
    return M.enterprise_conform(rows.where(~second), rows.where(second))


@query("enterprise_contacts", "ent_id:str contact:str mobile:str", """
SELECT DISTINCT md5(holder_name) AS ent_id, insurer AS contact, holder_mobile AS mobile FROM (SELECT * REPLACE (replace(insurer, ' ', '') AS insurer) FROM d_policy)""")
def enterprise_contacts(t: Tables) -> DataFrame:
    rows = t.policy.select(F.col("holder_name").alias("ent_name"), F.col("insurer").alias("contact"), F.col("holder_mobile").alias("mobile"), "start_date")
    return M.enterprise_contacts(rows.where("start_date <= date '1999-01-01'").drop("start_date"), rows.where("start_date >= date '1998-06-01'").drop("start_date"))


CTES["x_rates"] = "SELECT product_code, CAST(t AS DECIMAL(14,4)) AS p_tech, CAST(b AS DECIMAL(14,4)) AS p_broker FROM (VALUES " + ", ".join(
    f"('{c}', {a}, {b})" for c, a, b in PRODUCT_RATES) + ") v(product_code, t, b)"
CTES["x_plan"] = """
SELECT *, CASE WHEN tech_rate IS NOT NULL OR broker_rate IS NOT NULL THEN coalesce(tech_rate, 0) + coalesce(broker_rate, 0) END AS commission_rate FROM (
SELECT pl.policy_id, pl.product_code, CASE WHEN sku_coverage >= 150 THEN sku_coverage * 2 ELSE sku_coverage END AS sku_coverage,
  CASE WHEN sku_coverage >= 150 THEN NULL ELSE sku_ratio END AS sku_ratio, CASE WHEN sku_coverage >= 150 THEN sku_price + 1 ELSE sku_price END AS sku_price,
  sku_charge_type, CASE WHEN tech_rate > 0 THEN tech_rate ELSE p_tech END AS tech_rate,
  coalesce(CASE pl.product_code WHEN 'HOUSEHOLD' THEN 0.1 WHEN 'MACHINERY' THEN 0.2 END, broker_rate, p_broker) AS broker_rate
FROM d_plan pl LEFT JOIN x_rates r ON r.product_code = pl.product_code)"""


def plans(t: Tables) -> DataFrame:
    now = t.plan.withColumn("tech_rate", F.when(F.col("tech_rate") > 0, F.col("tech_rate")))
    history = t.plan.where("sku_coverage >= 150").select(
        "policy_id", (F.col("sku_coverage") * 2).alias("sku_coverage"), F.lit(None).cast("string").alias("sku_ratio"),
        (F.col("sku_price") + 1).alias("sku_price"), "sku_charge_type",
    )
    rates = literal_table(t.spark, ["product_code", "tech_rate", "broker_rate"], PRODUCT_RATES)
    rates = rates.select("product_code", F.col("tech_rate").cast(MONEY).alias("tech_rate"), F.col("broker_rate").cast(MONEY).alias("broker_rate"))
    return M.plan_conform(now, history, rates, FIXED_RATES)


@query("plan_conform", "policy_id:long product_code:str sku_coverage:double sku_ratio:str sku_price:double sku_charge_type:long tech_rate:double "
       "broker_rate:double commission_rate:double", "SELECT * FROM x_plan")
def plan_conform(t: Tables) -> DataFrame:
    return plans(t)


CTES["x_endorsement_person"] = """
SELECT i.policy_id, insured_id, 'E' || CAST(i.policy_id AS VARCHAR) || '-' || CAST(workplace_id % 2 AS VARCHAR) AS preserve_id,
  CASE WHEN workplace_id % 4 <> 3 THEN start_date END AS join_date, CASE WHEN workplace_id % 4 <> 0 THEN end_date END AS leave_date FROM d_insured i"""
CTES["x_endorsement_source"] = """
SELECT preserve_id, policy_id, CASE WHEN policy_id % 3 = 0 THEN 0 ELSE count(join_date) END AS add_person_count, count(leave_date) AS del_person_count,
  [1, 2, 5, 7][policy_id % 4 + 1] AS source_type FROM x_endorsement_person GROUP BY 1, 2"""


def endorsement_person(t: Tables) -> DataFrame:
    w = F.col("workplace_id")
    return t.insured.select(
        "policy_id", "insured_id",
        F.concat(F.lit("E"), F.col("policy_id").cast("string"), F.lit("-"), F.pmod(w, F.lit(2)).cast("string")).alias("preserve_id"),
        F.when(F.pmod(w, F.lit(4)) != 3, F.col("start_date")).alias("join_date"),
        F.when(F.pmod(w, F.lit(4)) != 0, F.col("end_date")).alias("leave_date"),
    )


def endorsement_source(t: Tables) -> DataFrame:
    types = F.array(F.lit(1), F.lit(2), F.lit(5), F.lit(7))
    joined = F.when(F.pmod("policy_id", F.lit(3)) == 0, 0).otherwise(F.count("join_date"))
    return (
        endorsement_person(t).groupBy("preserve_id", "policy_id")
        .agg(joined.alias("add_person_count"), F.count("leave_date").alias("del_person_count"))
        .withColumn("source_type", F.element_at(types, (F.pmod("policy_id", F.lit(4)) + 1).cast("int")))
        .join(t.policy.select("policy_id", F.col("start_date").alias("created")), "policy_id")
    )


@query("endorsement_conform", "preserve_id:str policy_id:long preserve_type:long preserve_start:str preserve_end:str effective_date:str "
       "add_person_count:long del_person_count:long", """
SELECT s.preserve_id, s.policy_id, CASE WHEN source_type IN (1, 2) THEN source_type WHEN source_type = 5 THEN 3 ELSE -1 END AS preserve_type,
  CASE WHEN NOT (add_person_count = 0 AND del_person_count > 0) THEN j END AS preserve_start,
  CASE WHEN add_person_count = 0 AND del_person_count > 0 THEN l + 1 ELSE l END AS preserve_end,
  CASE WHEN add_person_count = 0 AND del_person_count > 0 THEN l + 1 WHEN source_type = 5 THEN p.start_date ELSE j END AS effective_date,
  add_person_count, del_person_count
FROM x_endorsement_source s JOIN d_policy p ON p.policy_id = s.policy_id
LEFT JOIN (SELECT preserve_id, max(coalesce(join_date, leave_date)) AS j, min(coalesce(leave_date, join_date)) AS l FROM x_endorsement_person GROUP BY 1) d
  ON d.preserve_id = s.preserve_id""")
def endorsement_conform(t: Tables) -> DataFrame:
    return M.endorsement_conform(endorsement_source(t), endorsement_person(t).drop("policy_id"))


@query("endorsement_people", "preserve_id:str policy_id:long insured_id:str cert_no:str join_date:str leave_date:str person_type:long", """
SELECT DISTINCT e.preserve_id, e.policy_id, e.insured_id, cert_no, join_date, leave_date, CASE WHEN leave_date IS NULL THEN 1 ELSE 2 END AS person_type
FROM x_endorsement_person e JOIN d_insured i ON i.insured_id = e.insured_id AND i.policy_id = e.policy_id""")
def endorsement_people(t: Tables) -> DataFrame:
    # dealt by the id they are joined on, which also serves to tell equal rows: one shuffle each in place of two
    people = endorsement_person(t).repartition("preserve_id")
    headers = people.select("preserve_id", "policy_id").distinct()
    return M.endorsement_people(people.drop("policy_id").distinct(), headers, t.insured.select("policy_id", "insured_id", "cert_no").distinct())


@query("work_grade_conform", "policy_id:long profession_type:str disability_scale:str headcount_band:str insured_number_band:str join_social:str "
       "is_commission:str", """
SELECT policy_id, CASE policy_id % 5 WHEN 2 THEN '1-3类' WHEN 3 THEN '1-4类' WHEN 4 THEN '5类' ELSE coalesce(nullif(profession_type, ''), 'X') END AS profession_type,
  CASE policy_id % 3 WHEN 0 THEN '0.05' WHEN 1 THEN 'own' ELSE '0.1' END AS disability_scale,
  CASE policy_id % 2 WHEN 0 THEN '101-300' ELSE ':501人及以上' END AS headcount_band,
  CASE policy_id % 4 WHEN 1 THEN '1-50' WHEN 2 THEN '51-500' WHEN 3 THEN '501以上' ELSE '0' END AS insured_number_band,
  CASE policy_id % 3 WHEN 1 THEN 'Y' WHEN 0 THEN 'N' END AS join_social,
  CASE policy_id % 3 WHEN 1 THEN 'Y' WHEN 0 THEN 'N' ELSE '2' END AS is_commission FROM d_work_grade""")
def work_grade_conform(t: Tables) -> DataFrame:
    """Four catalogues that know different columns of a policy's plan."""
    i, none = F.col("policy_id"), F.lit(None).cast("string")
    grade = t.work_grade
    codes = F.when(F.pmod(i, F.lit(5)) >= 2, F.concat(F.lit("K"), F.pmod(i, F.lit(5)).cast("string")))
    layers = [
        {"profession_code": codes},
        {"profession_type": F.when(F.length("profession_type") > 0, F.col("profession_type"))},
        {"disability_scale": F.when(F.pmod(i, F.lit(3)) == 0, "K2").when(F.pmod(i, F.lit(3)) == 1, "own"), "profession_type": F.lit("X")},
        {"disability_scale": F.lit("K3"), "min_num": F.when(F.pmod(i, F.lit(2)) == 0, "K2").otherwise("K4"),
         "insured_number": F.pmod(i, F.lit(4)).cast("string"), "join_social": F.pmod(i, F.lit(3)).cast("string"), "is_commission": F.pmod(i, F.lit(3)).cast("string")},
    ]
    columns = ["profession_code", "profession_type", "disability_scale", "min_num", "insured_number", "join_social", "is_commission"]
    return M.work_grade_conform([grade.select("policy_id", F.lit(1).alias("row_id"), *[layer.get(c, none).alias(c) for c in columns]) for layer in layers])


CTES["x_latest_region"] = """
SELECT holder_name, region_code AS latest_region FROM d_policy WHERE region_code IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY holder_name ORDER BY start_date DESC, policy_id DESC) = 1"""
CTES["x_named_sales"] = """
SELECT s.* EXCLUDE (channel_name), CASE WHEN channel_name = '直客' THEN ent_name ELSE channel_name END AS channel_name, team_name, department, group_name
FROM d_sales s LEFT JOIN d_sales_team t ON t.sale_name = s.salesman"""
CTES["x_master"] = f"""
SELECT p.policy_id, p.policy_code, p.policy_status, p.start_date, p.end_date, split_part(insurer, '-', 2) AS insurer_short, p.holder_name, p.first_premium,
  p.product_code, product_name, a.province AS holder_province, a.city AS holder_city, s.channel_name, s.salesman, s.team_name, s.department, s.biz_operator,
  sku_price, sku_ratio, tech_rate, broker_rate, profession_type
FROM d_policy p JOIN d_product r ON r.product_code = p.product_code AND one_level = '{LINE}'
LEFT JOIN x_latest_region l ON l.holder_name = p.holder_name LEFT JOIN d_area a ON a.code = substr(latest_region, 1, 4) || '00'
LEFT JOIN x_named_sales s ON s.ent_name = p.holder_name LEFT JOIN d_plan pl ON pl.policy_id = p.policy_id LEFT JOIN d_work_grade g ON g.policy_id = p.policy_id
WHERE p.policy_status IN (0, 1, -1)"""


def master(t: Tables) -> DataFrame:
    return M.policy_master_wide(t.policy, t.area, t.sales, t.sales_team, t.product, t.plan, t.work_grade, LINE)


@query("policy_master_wide", "policy_id:long policy_code:str policy_status:long insurer_short:str holder_name:str first_premium:double product_name:str "
       "holder_province:str holder_city:str channel_name:str salesman:str team_name:str department:str biz_operator:str sku_price:double "
       "tech_rate:double broker_rate:double profession_type:str", "SELECT * FROM x_master")
def policy_master_wide(t: Tables) -> DataFrame:
    return master(t)


@query("policy_person_wide", "insured_id:str policy_id:long cert_no:str cover_start:str cover_end:str channel_name:str salesman:str team_name:str "
       "profession_type:str sku_price:double claim_payable:double", """
SELECT i.insured_id, i.policy_id, i.cert_no, greatest(coalesce(i.start_date, i.end_date), m.start_date) AS cover_start,
  least(coalesce(i.end_date, i.start_date), m.end_date) AS cover_end, channel_name, salesman, team_name, profession_type, sku_price, claim_payable
FROM d_insured i JOIN x_master m ON m.policy_id = i.policy_id
LEFT JOIN x_claims_in_cover c ON c.policy_id = i.policy_id AND c.cert_no = i.cert_no AND c.start_date = i.start_date""")
def policy_person_wide(t: Tables) -> DataFrame:
    return M.policy_person_wide(master(t), t.insured, t.claim)


CTES["x_sport_customer"] = """
SELECT city AS name, CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 2 END AS type, CASE WHEN n_nationkey % 3 <> 0 THEN 'Supplier#00000000' || CAST(n_nationkey % 10 AS VARCHAR) END AS sales_name,
  CASE WHEN n_nationkey % 4 <> 0 THEN province END AS customer_type, CASE WHEN n_nationkey % 5 <> 0 THEN '线下' END AS source FROM d_area"""


def sport_customers(t: Tables) -> DataFrame:
    n = F.col("n_nationkey")
    return t.area.select(
        F.col("city").alias("name"), F.when(F.pmod(n, F.lit(2)) == 0, 1).otherwise(2).alias("type"),
        F.when(F.pmod(n, F.lit(3)) != 0, F.concat(F.lit("Supplier#00000000"), F.pmod(n, F.lit(10)).cast("string"))).alias("sales_name"),
        F.when(F.pmod(n, F.lit(4)) != 0, F.col("province")).alias("customer_type"), F.when(F.pmod(n, F.lit(5)) != 0, "线下").alias("source"),
    )


CTES["x_other_master"] = """
SELECT p.policy_id, p.holder_name, p.channel, md5(p.channel) AS channel_id, business_line, p.product_code, p.first_premium, p.start_date, p.end_date, sales_name, team_name, department, tech_rate, broker_rate
FROM (SELECT p.*, business_line, coalesce(CASE WHEN policy_id % 2 = 0 THEN 'Supplier#000000001' END,
    CASE business_line WHEN '体育' THEN c.sales_name WHEN '健康' THEN '健康部' WHEN '员福' THEN '公司' WHEN '场景' THEN '公司' END) AS sales_name
  FROM d_policy p JOIN d_product r ON r.product_code = p.product_code AND business_line NOT IN ('雇主', '接口')
  LEFT JOIN (SELECT * FROM x_sport_customer WHERE type = 1) c ON c.name = p.channel WHERE policy_status IN (0, 1, -1)) p
LEFT JOIN d_sales_team t ON t.sale_name = p.sales_name LEFT JOIN d_plan pl ON pl.policy_id = p.policy_id"""


# Fixed values of the test tables: the default salesman of a line of business.
LINE_SALESMAN = {"健康": "健康部", "员福": "公司", "场景": "公司"}


def other_master(t: Tables) -> DataFrame:
    policy = t.policy.withColumn("policy_sales", F.when(F.pmod("policy_id", F.lit(2)) == 0, "Supplier#000000001"))
    return M.non_employer_master(policy, t.product, sport_customers(t), t.sales_team, t.plan, ["雇主", "接口"], LINE_SALESMAN)


@query("non_employer_master", "policy_id:long holder_name:str channel:str channel_id:str business_line:str sales_name:str team_name:str department:str "
       "tech_rate:double broker_rate:double", "SELECT * FROM x_other_master")
def non_employer_master(t: Tables) -> DataFrame:
    return other_master(t)


@query("holder_summary", "holder_name:str insurer:str first_start:str region_code:str holder_province:str holder_city:str channel_name:str salesman:str team_name:str", """
WITH c AS (SELECT p.* FROM d_policy p JOIN d_product r ON r.product_code = p.product_code AND two_level IN ('雇主') WHERE policy_status IN (0, 1, -1)),
n AS (SELECT holder_name, region_code FROM c WHERE region_code IS NOT NULL QUALIFY row_number() OVER (PARTITION BY holder_name ORDER BY start_date DESC, policy_id DESC) = 1)
SELECT f.*, n.region_code, a.province AS holder_province, a.city AS holder_city, channel_name, salesman, team_name
FROM (SELECT holder_name, insurer, min(start_date) AS first_start FROM c GROUP BY 1, 2) f LEFT JOIN n ON n.holder_name = f.holder_name
LEFT JOIN d_area a ON a.code = substr(n.region_code, 1, 4) || '00' LEFT JOIN x_named_sales s ON s.ent_name = f.holder_name""")
def holder_summary(t: Tables) -> DataFrame:
    products = t.product.withColumn("two_level", F.col("two_level"))
    return M.holder_summary(t.policy, t.area, t.sales, t.sales_team, products, ["雇主"])


@query("salesman_assignment", "ent_id:str ent_name:str channel_id:str channel_name:str salesman:str biz_operator:str", """
WITH stored AS (SELECT s.* FROM d_sales s JOIN d_customer c ON c.holder_name = s.ent_name WHERE balance >= 1000),
known AS (SELECT k, min((salesman, biz_operator)) AS v FROM (SELECT CASE WHEN channel_name = '直客' THEN ent_name ELSE channel_name END AS k, salesman, biz_operator FROM stored) GROUP BY 1),
p AS (SELECT DISTINCT c.holder_name, c.province, s.salesman, CASE WHEN s.channel_name = '直客' THEN '直客' ELSE s.channel_name END AS ch
  FROM d_policy c JOIN d_sales s ON s.ent_name = c.holder_name),
n AS (SELECT md5(holder_name) AS ent_id, holder_name AS ent_name, CASE WHEN ch = '直客' THEN md5(holder_name) ELSE md5(ch) END AS channel_id, ch AS channel_name, salesman, province,
  CASE WHEN ch = '直客' THEN holder_name ELSE ch END AS k FROM p WHERE md5(holder_name) NOT IN (SELECT ent_id FROM stored))
SELECT ent_id, ent_name, channel_id, channel_name, CASE WHEN known.k IS NOT NULL THEN v[1] ELSE n.salesman END AS salesman,
  CASE WHEN known.k IS NOT NULL THEN v[2] ELSE 'BY-' || province END AS biz_operator
FROM n LEFT JOIN known ON known.k = n.k""")
def salesman_assignment(t: Tables) -> DataFrame:
    proposal = t.policy.select("holder_name", "province").join(
        t.sales.select(F.col("ent_name").alias("holder_name"), "channel_name", "salesman"), "holder_name"
    ).withColumn("channel_user_type", F.when(F.col("channel_name") == "直客", 2).otherwise(1))
    rich = t.customer.where("balance >= 1000").select(F.col("holder_name").alias("ent_name"))
    stored = t.sales.join(rich, "ent_name", "left_semi")
    operators = t.area.select("province", F.concat(F.lit("BY-"), "province").alias("biz_operator")).distinct()
    return M.salesman_assignment(proposal, stored, operators)


def instalments(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    events = t.raw("events").select(
        F.concat(F.lit("N"), F.col("event_id").cast("string")).alias("policy_no"), F.col("value").cast(MONEY).alias("premium"),
        F.when(F.col("event_type") == "purchase", 2).otherwise(1).alias("status"), F.date_trunc("second", "ts").alias("paid_at"),
    )
    policy = t.policy.select(
        F.concat(F.lit("N"), F.col("policy_id").cast("string")).alias("policy_no"), "policy_code", "holder_name", "channel",
        F.concat(F.lit("T"), F.col("policy_id").cast("string")).alias("proposal_no"),
    )
    person = t.policy.select(F.concat(F.lit("T"), F.col("policy_id").cast("string")).alias("proposal_no"), F.col("insurer").alias("insured_name"))
    return events, policy, person


_PAID = """
SELECT {number} || '_' || strftime(ts, '%Y%m%d%H%M%S') AS preserve_id, 'N' || CAST(event_id AS VARCHAR) AS policy_no,
  CAST(value AS DECIMAL(14,4)) AS premium, holder_name, channel, insurer AS insured_name
FROM events LEFT JOIN d_policy ON policy_id = event_id WHERE event_type = 'purchase'"""


@query("health_instalments", "preserve_id:str policy_no:str premium:double holder_name:str channel:str insured_name:str", _PAID.format(number="policy_code"))
def health_instalments(t: Tables) -> DataFrame:
    return M.paid_instalments(*instalments(t), "policy_code")


@query("health_renewals", "preserve_id:str policy_no:str premium:double holder_name:str channel:str insured_name:str",
       _PAID.format(number="'N' || CAST(event_id AS VARCHAR)"))
def health_renewals(t: Tables) -> DataFrame:
    return M.paid_instalments(*instalments(t), "policy_no")


@query("proposal_person_risk", "insured_id:str policy_id:long holder_name:str work_type:str profession_type:str work_name_check:str work_risk:str gs_first:str", """
SELECT i.insured_id, i.policy_id, holder_name, work_type, profession_type, m.work_name_check, standard_work_risk AS work_risk, substr(gs_work_risk, 1, 1) AS gs_first
FROM d_policy p JOIN d_insured_work i ON i.policy_id = p.policy_id LEFT JOIN d_work_grade g ON g.policy_id = p.policy_id
LEFT JOIN d_work_match m ON m.primitive_work = work_type LEFT JOIN d_work_risk r ON r.standard_work_name = m.work_name_check""")
def proposal_person_risk(t: Tables) -> DataFrame:
    return M.proposal_person_risk(t.policy.select("policy_id", "holder_name"), t.insured_work, t.work_grade, t.work_match, t.work_risk)


@query("insured_location", "insured_id:str policy_id:long holder_name:str holder_province:str holder_city:str insured_province:str insured_city:str "
       "job_company:str job_province:str job_city:str channel_name:str", f"""
WITH longest AS (SELECT holder_name, region_code FROM d_policy WHERE region_code IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY holder_name ORDER BY length(region_code) DESC, policy_id DESC) = 1),
first AS (SELECT holder_name, region_code FROM d_policy QUALIFY row_number() OVER (PARTITION BY holder_name ORDER BY start_date, policy_id) = 1),
base AS (SELECT p.policy_id, p.holder_name, a.province AS hp, a.city AS hc, channel_name FROM d_policy p
  JOIN d_product r ON r.product_code = p.product_code AND one_level = '{LINE}' LEFT JOIN longest l ON l.holder_name = p.holder_name
  LEFT JOIN d_area a ON a.code = substr(l.region_code, 1, 4) || '00' LEFT JOIN x_named_sales s ON s.ent_name = p.holder_name WHERE policy_status IN (0, 1, -1)),
people AS (SELECT insured_id, policy_id, cert_no, CASE WHEN workplace_id % 2 = 0 THEN c_name END AS job_company FROM d_insured LEFT JOIN customer ON c_custkey = workplace_id)
SELECT i.insured_id, b.policy_id, b.holder_name, hp AS holder_province, hc AS holder_city, ia.province AS insured_province, ia.city AS insured_city,
  coalesce(i.job_company, b.holder_name) AS job_company, coalesce(ja.province, hp) AS job_province, coalesce(ja.city, hc) AS job_city, channel_name
FROM base b LEFT JOIN people i ON i.policy_id = b.policy_id LEFT JOIN d_area ia ON ia.code = substr(i.cert_no, 1, 4) || '00'
LEFT JOIN first f ON f.holder_name = coalesce(i.job_company, b.holder_name) LEFT JOIN d_area ja ON ja.code = substr(f.region_code, 1, 4) || '00'""")
def insured_location(t: Tables) -> DataFrame:
    names = t.customer.select(F.col("holder_id").alias("workplace_id"), "holder_name")
    # only people of the policies asked for are dealt by workplace
    listed = t.insured.join(M.located_policies(t.policy, t.product, LINE).select("policy_id"), "policy_id", "left_semi")
    people = listed.join(names, "workplace_id", "left").withColumn(
        "job_company", F.when(F.pmod("workplace_id", F.lit(2)) == 0, F.col("holder_name"))
    ).drop("holder_name")
    return M.insured_location(t.policy, people, t.area, t.product, t.sales, LINE)


@query("sports_policies", "policy_id:long holder_name:str channel:str product_name:str policy_type:str start_date:str people:long premium:double "
       "customer_type:str sales_name:str source:str", """
SELECT p.policy_id, holder_name, channel, product_name, CASE WHEN charge_type = 1 THEN '个单' ELSE '团单' END AS policy_type,
  greatest(start_date, CASE WHEN policy_id % 3 <> 0 THEN start_date + 5 ELSE start_date END) AS start_date, person_count AS people, first_premium AS premium,
  CASE WHEN c.name IS NOT NULL THEN coalesce(customer_type, '日常营销') END AS customer_type, CASE WHEN c.name IS NOT NULL THEN coalesce(sales_name, '体育部') END AS sales_name,
  CASE WHEN c.name IS NOT NULL THEN coalesce(source, '线上业务') END AS source
FROM d_policy p JOIN d_product r ON r.product_code = p.product_code AND business_line = '体育'
LEFT JOIN (SELECT * FROM x_sport_customer WHERE type = 1) c ON c.name = p.channel WHERE policy_status IN (0, 1, -1)""")
def sports_policies(t: Tables) -> DataFrame:
    policy = t.policy.withColumns(
        {"created": F.when(F.pmod("policy_id", F.lit(3)) != 0, F.date_add("start_date", 5)), "policy_type": F.col("charge_type").cast("string")}
    )
    return M.sports_policies(policy, t.product, sport_customers(t), "体育部")
