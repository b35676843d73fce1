"""Claims."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.functions.dates import text_date
from coverlake.functions.text import drop_empty
from coverlake.operators.premium import day_prices
from coverlake.operators.timeline import sums_inside

MONEY = "decimal(14,4)"


def claim_conform(raw: DataFrame) -> DataFrame:
    """Typed claims: payable is the final payment, or the reserve where no final payment is known."""
    final, reserve = drop_empty(F.col("final_payment")), drop_empty(F.col("pre_com"))
    return raw.select(
        "case_no",
        "policy_id",
        "person_id",
        "risk_cert_no",
        "case_status",
        "case_type",
        text_date(F.col("risk_date")).alias("risk_day"),
        F.coalesce(final, reserve).cast(MONEY).alias("payable"),
        final.cast(MONEY).alias("settled"),
        reserve.cast(MONEY).alias("reserve"),
    )


# Liability codes by benefit column.
LIABILITY_COLUMNS = {
    "hos_benefits": ["2000000224"],
    "medical_coverage": ["2000000217", "2000000216", "2000000219", "2000000220", "2000000256", "2000000255"],
    "delay_payment": ["2000000229"],
    "disable_death_payment": ["2000000209", "2000000213"],
}
SETTLED = "结案"


def claim_liability_pivot(claim: DataFrame, liability: DataFrame) -> DataFrame:
    """Benefit amounts by kind of liability beside each claim that is not void (status -1)."""
    def amount(codes: list[str]):
        return F.sum(F.when(F.col("liability_code").isin(codes), F.col("amount")).otherwise(F.lit(0).cast(MONEY)))

    benefits = liability.groupBy("claim_no").agg(*[amount(codes).alias(name) for name, codes in LIABILITY_COLUMNS.items()])
    live = claim.where(F.col("status") != -1).withColumn("notice_no", F.coalesce("notice_no", "claim_no"))
    return live.join(benefits, "claim_no", "left")


def claim_notice_merge(notice: DataFrame, person: DataFrame, loss: DataFrame) -> DataFrame:
    """A notice with the person it is about and the loss it reports."""
    return notice.join(person, "notice_no", "left").join(loss, "notice_no", "left")


def grade_bounds(work_grade: DataFrame) -> DataFrame:
    """Lowest and highest class a grade admits: ``a-b类`` is (a, b), ``n类`` is (1, n), empty is (-1, -1)."""
    text = F.col("profession_type")
    high = F.regexp_extract(text, "(\\d+)类?$", 1).try_cast("int")
    low = F.when(text.contains("-"), F.regexp_extract(text, "^(\\d+)", 1).try_cast("int")).otherwise(F.lit(1))
    known = F.length(text) > 0
    return work_grade.select(
        "policy_id",
        "profession_type",
        F.when(known, low).otherwise(-1).alias("grade_low"),
        F.when(known, high).otherwise(-1).alias("grade_high"),
    )


def standard_risk(work_risk: DataFrame) -> DataFrame:
    """One class per standard work type: the smallest one; the insurer's class is the part before the bar, ``S`` is 0."""
    first = F.split_part(F.col("gs_work_risk"), F.lit("|"), F.lit(1))
    gs = F.when(F.col("gs_work_risk") == "", -1).when(first == "S", 0).otherwise(first.try_cast("int"))
    return (
        work_risk.where(F.col("gs_work_risk").isNotNull())
        .groupBy(F.col("standard_work_name").alias("work_name_check"))
        .agg(F.min("standard_work_risk").alias("work_risk"), F.min(gs).alias("gs_work_risk"))
    )


def work_type_match(insured: DataFrame, work_grade: DataFrame, work_match: DataFrame, work_risk: DataFrame) -> DataFrame:
    """Insured people with standard work type, risk class and whether the plan's grade covers that class."""
    unknown, known = F.lit("未知"), F.lit("已知")
    rows = (
        insured.join(grade_bounds(work_grade), "policy_id", "left")
        .join(work_match, F.col("work_type") == F.col("primitive_work"), "left")
        .join(standard_risk(work_risk), "work_name_check", "left")
    )
    risk = F.col("work_risk").try_cast("int")

    def covered(c):
        inside = c.between(F.col("grade_low"), F.col("grade_high"))
        return F.when(F.col("profession_type").isNotNull() & inside, known).otherwise(unknown)

    return rows.select(
        *insured.columns,
        "profession_type",
        "grade_low",
        "grade_high",
        "work_name_check",
        "work_risk",
        "gs_work_risk",
        F.when(F.col("work_type").isNull() | F.col("primitive_work").isNotNull(), "已匹配").otherwise("未匹配").alias("recognition"),
        F.when(F.col("work_type").isNull(), 2)
        .when(F.col("work_name_check") != "未知", 1)
        .otherwise(0)
        .alias("whether_recognition"),
        covered(risk).alias("plan_recognition"),
        covered(F.col("gs_work_risk")).alias("gs_plan_recognition"),
    )


def claims_in_cover(insured: DataFrame, claim: DataFrame) -> DataFrame:
    """Payable claims of each (policy, person, cover start), and a flag-like count of them.

    A claim belongs to a cover if its date lies inside it, or if it has no date; a cover without an end holds only the
    latter. Several covers with one start add up.
    """
    facts = claim.select(
        "policy_id", F.col("risk_cert_no").alias("cert_no"), "risk_day", "payable", F.lit(1).cast("bigint").alias("cases")
    )
    covers = insured.where(F.col("start_date").isNotNull() & F.col("cert_no").isNotNull()).withColumn(
        "until", F.coalesce("end_date", F.date_sub("start_date", 1))
    )
    keys = ["policy_id", "cert_no"]
    # covers of people without a claim would sum up to none: they are left out before they are dealt and sorted
    claimants = facts.select(*keys).distinct()
    covers = covers.join(claimants, keys, "left_semi").unionByName(covers.where(F.col("policy_id").isNull()))
    multiplicity = covers.groupBy(*keys, "start_date", "until").agg(F.count(F.lit(1)).alias("times"))
    return (
        sums_inside(multiplicity, facts, keys, "start_date", "until", "risk_day", ["payable", "cases"])
        .groupBy("policy_id", "cert_no", "start_date")
        .agg(
            F.sum(F.col("payable") * F.col("times")).alias("claim_payable"),
            F.sum(F.col("cases") * F.col("times")).alias("claim_cases"),
        )
        .where(F.col("claim_cases") > 0)
    )


def earned_in_cover(cover: DataFrame, as_of: date) -> DataFrame:
    """Premium earned up to today by (policy, person, raw cover start)."""
    last = F.least("cover_end", F.lit(as_of))
    days = F.when(F.col("cover_start") <= last, F.datediff(last, "cover_start") + 1)
    return (
        day_prices(cover)
        .where(days.isNotNull())
        .groupBy("policy_id", "cert_no", F.col("listed_start").alias("start_date"))
        .agg(F.sum(F.col("day_price") * days).alias("earned"))
    )


def work_type_claim(work: DataFrame, insured: DataFrame, claim: DataFrame, cover: DataFrame, as_of: date) -> DataFrame:
    """Matched work types with the claims inside each cover and the premium it has earned.

    ``insured`` is the list ``work`` was matched from: the claims need none of the matched columns.
    """
    keys = ["policy_id", "cert_no", "start_date"]
    return (
        work.join(claims_in_cover(insured, claim).drop("claim_cases"), keys, "left")
        .join(earned_in_cover(cover, as_of), keys, "left")
        .select(
            *work.columns,
            F.coalesce("claim_payable", F.lit(0)).cast("decimal(20,4)").alias("payable"),
            F.col("earned").cast("decimal(20,4)").alias("earned"),
        )
    )


def claim_daily(claim: DataFrame) -> DataFrame:
    """Cases, settled pay and total pay by policy and day of risk; undated claims are left out."""
    return (
        claim.where(F.col("risk_day").isNotNull())
        .groupBy("policy_id", F.col("risk_day").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("cases"),
            F.sum(F.when(F.col("case_status") == SETTLED, F.col("payable")).otherwise(F.lit(0).cast(MONEY))).alias("settled"),
            F.sum("payable").alias("payable"),
        )
    )


def expired_premium(cover: DataFrame, policy: DataFrame) -> DataFrame:
    """All premium of a policy, booked on its end day."""
    days = F.datediff("cover_end", "cover_start") + 1
    total = day_prices(cover).groupBy("policy_id").agg(F.sum(F.col("day_price") * days).alias("expired_premium"))
    return policy.select("policy_id", F.col("end_date").alias("day")).join(total, "policy_id")


def expired_claims(claim: DataFrame, policy: DataFrame) -> DataFrame:
    """All claims dated inside a policy's period, booked on its end day; zero where there are none."""
    periods = policy.select("policy_id", "start_date", F.col("end_date").alias("day"))
    total = (
        claim.join(periods, "policy_id")
        .where(F.col("risk_day").between(F.col("start_date"), F.col("day")))
        .groupBy("policy_id")
        .agg(F.sum("payable").alias("paid"))
    )
    return periods.drop("start_date").join(total, "policy_id", "left").select(
        "policy_id", "day", F.coalesce("paid", F.lit(0)).cast("decimal(24,4)").alias("expired_claims")
    )
