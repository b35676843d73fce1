"""Claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.adapters import AS_OF, Tables
from coverlake.functions import certificate
from coverlake.operators import claims as C
from coverlake.operators import premium as P
from coverlake.oracle import CTES, TODAY, age_sql
from coverlake.registry import query

CTES["x_grade"] = """
SELECT policy_id, profession_type,
  CASE WHEN profession_type = '' THEN -1 WHEN contains(profession_type, '-') THEN CAST(substr(profession_type, 1, 1) AS INTEGER) ELSE 1 END AS grade_low,
  CASE WHEN profession_type = '' THEN -1 WHEN contains(profession_type, '-') THEN CAST(substr(profession_type, 3, 1) AS INTEGER)
       ELSE CAST(substr(profession_type, 1, 1) AS INTEGER) END AS grade_high
FROM d_work_grade"""
CTES["x_standard_risk"] = """
SELECT standard_work_name AS work_name_check, min(standard_work_risk) AS work_risk,
  min(CASE WHEN gs_work_risk = '' THEN -1 WHEN split_part(gs_work_risk, '|', 1) = 'S' THEN 0
           ELSE CAST(split_part(gs_work_risk, '|', 1) AS INTEGER) END) AS gs_work_risk
FROM d_work_risk GROUP BY 1"""
CTES["x_work"] = f"""
SELECT i.*, g.profession_type, grade_low, grade_high, m.work_name_check, work_risk, gs_work_risk,
  CASE WHEN work_type IS NULL OR primitive_work IS NOT NULL THEN '已匹配' ELSE '未匹配' END AS recognition,
  CASE WHEN work_type IS NULL THEN 2 WHEN m.work_name_check IS NULL OR m.work_name_check = '未知' THEN 0 ELSE 1 END AS whether_recognition,
  CASE WHEN g.profession_type IS NULL THEN '未知' WHEN CAST(work_risk AS INTEGER) BETWEEN grade_low AND grade_high THEN '已知' ELSE '未知' END AS plan_recognition,
  CASE WHEN g.profession_type IS NULL THEN '未知' WHEN gs_work_risk BETWEEN grade_low AND grade_high THEN '已知' ELSE '未知' END AS gs_plan_recognition,
  {age_sql('cert_no', 'start_date')} AS age,
  CASE WHEN length(cert_no) = 18 THEN TRY_CAST(substr(cert_no, 17, 1) AS INTEGER) % 2 END AS gender
FROM d_insured_work i LEFT JOIN x_grade g ON i.policy_id = g.policy_id LEFT JOIN d_work_match m ON work_type = primitive_work
LEFT JOIN x_standard_risk r ON r.work_name_check = m.work_name_check"""
CTES["x_claims_in_cover"] = """
SELECT i.policy_id, i.cert_no, i.start_date, sum(payable) AS claim_payable
FROM d_insured i JOIN d_claim c ON i.policy_id = c.policy_id AND i.cert_no = c.risk_cert_no
WHERE i.start_date IS NOT NULL AND (risk_day IS NULL OR risk_day BETWEEN i.start_date AND i.end_date)
GROUP BY 1, 2, 3"""
CTES["x_earned_in_cover"] = f"""
SELECT x.policy_id, x.cert_no, i.start_date, sum(x.day_price) AS earned
FROM x_person_day x JOIN (SELECT DISTINCT insured_id, start_date FROM d_insured) i ON x.insured_id = i.insured_id
WHERE day <= {TODAY} GROUP BY 1, 2, 3"""
CTES["x_work_claim"] = """
SELECT w.*, coalesce(claim_payable, 0) AS payable, earned
FROM x_work w LEFT JOIN x_claims_in_cover c ON w.policy_id = c.policy_id AND w.cert_no = c.cert_no AND w.start_date = c.start_date
LEFT JOIN x_earned_in_cover e ON w.policy_id = e.policy_id AND w.cert_no = e.cert_no AND w.start_date = e.start_date"""
CTES["x_claim_daily"] = """
SELECT policy_id, risk_day AS day, count(*) AS cases, sum(CASE WHEN case_status = '结案' THEN payable ELSE 0 END) AS settled,
  sum(payable) AS payable FROM d_claim WHERE risk_day IS NOT NULL GROUP BY 1, 2"""
CTES["x_expired_premium"] = """
SELECT p.policy_id, p.end_date AS day, sum(premium) AS expired_premium
FROM d_policy p JOIN x_daily_premium d ON p.policy_id = d.policy_id GROUP BY 1, 2"""
CTES["x_expired_claims"] = """
SELECT p.policy_id, p.end_date AS day, coalesce(sum(c.payable), 0) AS expired_claims
FROM d_policy p LEFT JOIN x_claim_daily c ON p.policy_id = c.policy_id AND c.day BETWEEN p.start_date AND p.end_date GROUP BY 1, 2"""


def work(t: Tables) -> DataFrame:
    """Insured people with work class, nominal age at the start of cover and gender."""
    matched = C.work_type_match(t.insured_work_by_policy, t.work_grade, t.work_match, t.work_risk)
    return matched.withColumn("age", certificate.age_at(F.col("cert_no"), F.col("start_date"))).withColumn(
        "gender", certificate.gender(F.col("cert_no"))
    )


def listed_cover(t: Tables) -> DataFrame:
    """Clamped cover that still knows the start it was listed with."""
    return P.clamped_cover(t.insured.withColumn("listed_start", F.col("start_date")), t.policy)


def work_claim(t: Tables, *facts: DataFrame) -> DataFrame:
    """Work types with claims and premium; ``facts`` by policy are joined first, while the people are still dealt by policy."""
    people = work(t)
    for one in facts:
        people = people.join(one, "policy_id")
    return C.work_type_claim(people, t.insured, t.claim, listed_cover(t), AS_OF)


@query("claim_conform", "case_no:str policy_id:long risk_cert_no:str case_status:str case_type:str risk_day:str payable:double settled:double "
       "reserve:double", "SELECT * FROM d_claim")
def claim_conform(t: Tables) -> DataFrame:
    return C.claim_conform(t.claim_raw)


@query("claim_liability_pivot", "claim_no:str notice_no:str status:long hos_benefits:double medical_coverage:double delay_payment:double "
       "disable_death_payment:double", """
SELECT claim_no, coalesce(notice_no, claim_no) AS notice_no, status,
  sum(CASE WHEN liability_code = '2000000224' THEN amount ELSE 0 END) AS hos_benefits,
  sum(CASE WHEN liability_code IN ('2000000217', '2000000216', '2000000219', '2000000220', '2000000256', '2000000255') THEN amount ELSE 0 END) AS medical_coverage,
  sum(CASE WHEN liability_code = '2000000229' THEN amount ELSE 0 END) AS delay_payment,
  sum(CASE WHEN liability_code IN ('2000000209', '2000000213') THEN amount ELSE 0 END) AS disable_death_payment
FROM d_claim_source WHERE status <> -1 GROUP BY 1, 2, 3""")
def claim_liability_pivot(t: Tables) -> DataFrame:
    s = t.claim_source
    return C.claim_liability_pivot(s.select("claim_no", "notice_no", "status"), s.select("claim_no", "liability_code", "amount"))


@query("claim_notice_merge", "notice_no:str policy_id:long mobile:str loss_day:str", """
SELECT n.notice_no, n.policy_id, p.mobile, l.loss_day FROM d_claim_source n
LEFT JOIN (SELECT notice_no, mobile FROM d_claim_source WHERE status <> -1) p ON p.notice_no = n.notice_no
LEFT JOIN (SELECT notice_no, loss_day FROM d_claim_source WHERE loss_day IS NOT NULL) l ON l.notice_no = n.notice_no
WHERE n.notice_no IS NOT NULL""")
def claim_notice_merge(t: Tables) -> DataFrame:
    s = t.claim_source
    person = s.where("status <> -1").select("notice_no", "mobile")
    loss = s.where("loss_day is not null").select("notice_no", "loss_day")
    return C.claim_notice_merge(s.where("notice_no is not null").select("notice_no", "policy_id"), person, loss)


WORK_COLUMNS = ("insured_id:str policy_id:long cert_no:str work_type:str profession_type:str grade_low:long grade_high:long work_name_check:str "
                "work_risk:str gs_work_risk:long recognition:str whether_recognition:long plan_recognition:str gs_plan_recognition:str")


@query("work_type_match", WORK_COLUMNS, "SELECT * FROM x_work")
def work_type_match(t: Tables) -> DataFrame:
    return work(t)


@query("work_type_claim", "insured_id:str policy_id:long cert_no:str start_date:str work_risk:str payable:double earned:double",
       "SELECT * FROM x_work_claim")
def work_type_claim(t: Tables) -> DataFrame:
    return work_claim(t)


@query("claim_daily", "policy_id:long day:str cases:long settled:double payable:double", "SELECT * FROM x_claim_daily")
def claim_daily(t: Tables) -> DataFrame:
    return C.claim_daily(t.claim)


@query("expired_premium", "policy_id:long day:str expired_premium:double", "SELECT * FROM x_expired_premium")
def expired_premium(t: Tables) -> DataFrame:
    return C.expired_premium(P.clamped_cover(t.insured, t.policy), t.policy)


@query("expired_claims", "policy_id:long day:str expired_claims:double", "SELECT * FROM x_expired_claims")
def expired_claims(t: Tables) -> DataFrame:
    return C.expired_claims(t.claim, t.policy)


