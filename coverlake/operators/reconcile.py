"""The same key figures computed from each layer of the warehouse."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlake.operators.claims import SETTLED
from coverlake.operators.timeline import shared

DEAD, DISABLED = "死亡", "伤残"


def _claims(claim: DataFrame) -> DataFrame:
    """Per policy: cases and pay, by kind and state; two layers share them."""
    settled = F.trim("case_status") == SETTLED
    kinds = claim.groupBy("policy_id").agg(
        F.count("case_no").alias("cases"),
        F.sum("payable").alias("payable"),
        F.sum(F.when(settled, F.col("payable"))).alias("settled_payable"),
        F.count_if(F.trim("case_type") == DEAD).alias("dead_cases"),
        F.count_if(F.trim("case_type") == DISABLED).alias("disabled_cases"),
        F.count_if(settled).alias("settled_cases"),
    )
    return shared(kinds, "policy_id")


def _totals(rows: DataFrame, as_of: date, extra: dict[str, Column]) -> DataFrame:
    expired = F.col("end_date") <= F.lit(as_of)
    live = F.lit(as_of).between(F.col("start_date"), F.col("end_date"))
    sums = ["curr_insured", "person_count", "cases", "dead_cases", "disabled_cases", "settled_cases", "payable", "settled_payable", "premium"]
    return rows.agg(
        *[F.sum(c).alias(c) for c in sums],
        F.sum(F.when(expired, F.col("payable"))).alias("expired_payable"),
        F.countDistinct(F.when(live, F.col("channel_name"))).alias("live_channels"),
        F.countDistinct("channel_name").alias("channels"),
        *[c.alias(n) for n, c in extra.items()],
    )


def source_indicators(policy: DataFrame, insured: DataFrame, claim: DataFrame, endorsement: DataFrame, as_of: date) -> DataFrame:
    """From the conformed source tables: people and days are counted from the list of insured as it stands."""
    start, end = F.coalesce("start_date", "end_date"), F.coalesce("end_date", "start_date")
    last = F.least(end, F.lit(as_of))
    people = insured.groupBy("policy_id").agg(
        F.count_if(F.lit(as_of).between(start, end)).alias("curr_insured"),
        F.sum(F.when(start <= last, F.datediff(last, start) + 1).otherwise(0)).alias("person_count"),
    )
    moved = endorsement.where("preserve_status = 1").groupBy("policy_id").agg(F.sum(F.col("add_premium") + F.col("del_premium")).alias("moved"))
    rows = (
        policy.join(people, "policy_id", "left").join(_claims(claim), "policy_id", "left").join(moved, "policy_id", "left")
        .withColumn("premium", F.coalesce("first_premium", F.lit(0)) + F.coalesce("moved", F.lit(0)))
    )
    return _totals(rows, as_of, {})


def fact_indicators(
    policy: DataFrame, exposure: DataFrame, claim: DataFrame, ledger: DataFrame, earned: DataFrame, as_of: date
) -> DataFrame:
    """From the facts: head-counts per policy day, the premium ledger and earned premium."""
    booked = ledger.groupBy("policy_id").agg(F.sum("sum_premium").alias("premium"))
    rows = (
        policy.join(exposure, "policy_id", "left").join(_claims(claim), "policy_id", "left")
        .join(booked, "policy_id", "left").join(earned, "policy_id", "left")
    )
    expired = F.col("end_date") <= F.lit(as_of)
    return _totals(
        rows, as_of, {"earned": F.sum("earned_premium"), "expired_earned": F.sum(F.when(expired, F.col("earned_premium")))}
    )


def mart_indicators(monitor_today: DataFrame) -> DataFrame:
    """From the risk monitor: its running totals on the reporting day."""
    return monitor_today.agg(
        F.sum("head_count").alias("curr_insured"),
        F.sum("acc_head_count").alias("person_count"),
        F.sum("acc_cases").alias("cases"),
        F.sum("acc_payable").alias("payable"),
        F.sum("acc_settled").alias("settled_payable"),
        F.sum("acc_ledger_premium").alias("premium"),
        F.sum("acc_earned_premium").alias("earned"),
        F.sum("acc_expired_premium").alias("expired_earned"),
        F.sum("acc_expired_claims").alias("expired_payable"),
    )
