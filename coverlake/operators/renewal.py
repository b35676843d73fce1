"""Renewals, open business and daily operations."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlake.functions.dates import month_id
from coverlake.operators.premium import ANNUAL, MONTHLY, daily_headcount_runs, distinct_cover
from coverlake.operators.timeline import explode_days, explode_months, levels



def headcount_on(cover: DataFrame, days: dict[str, Column]) -> DataFrame:
    """Distinct people covered per policy on several days, from one scan of the covers. Policies with nobody have no row."""
    people = distinct_cover(cover)
    return people.groupBy("policy_id").agg(
        *[F.count_if((F.col("start") <= d) & (F.col("end") >= d)).alias(n) for n, d in days.items()]
    )


def renewed_people(policy: DataFrame, insured: DataFrame) -> DataFrame:
    """Per annual policy: distinct people covered on the reference day who are in force at the real renewal day elsewhere.

    Reference day is 30 days before the end, not before the start; renewal day 30 days after. A later cover counts if it is
    of the same holder and person, on a policy that starts at the earliest when this one ends. The search is a semi-join on
    (holder, person, month of the renewal day): it never pairs all covers of a person, and each person counts once.
    """
    periods = policy.select("policy_id", "holder_name", F.col("start_date").alias("p_start"), F.col("end_date").alias("p_end"))
    covers = insured.select("policy_id", "cert_no", "start_date", "end_date").join(periods, "policy_id")
    reference = F.greatest(F.date_sub("p_end", 30), F.col("p_start"))
    due = (
        covers.where((F.col("start_date") <= reference) & (F.col("end_date") >= reference))
        .select("policy_id", "holder_name", "cert_no", "p_end", F.date_add("p_end", 30).alias("renewal_day"))
        .distinct()
        .withColumn("month", F.trunc("renewal_day", "month"))
    )
    later = explode_months(
        covers.select("holder_name", "cert_no", F.col("p_start").alias("later_start"), "start_date", "end_date").distinct(), "start_date", "end_date"
    )
    d, n = due.alias("d"), later.alias("n")
    same = [F.col(f"d.{k}") == F.col(f"n.{k}") for k in ("holder_name", "cert_no", "month")]
    in_force = (F.col("n.start_date") <= F.col("d.renewal_day")) & (F.col("n.end_date") >= F.col("d.renewal_day"))
    kept = d.join(n, same[0] & same[1] & same[2] & in_force & (F.col("n.later_start") >= F.col("d.p_end")), "left_semi")
    return kept.groupBy("policy_id").agg(F.countDistinct("cert_no").alias("renewed"))


def annual_renewal(policy: DataFrame, insured: DataFrame, cover: DataFrame, as_of: date) -> DataFrame:
    """Annual policies with their due day, people to renew, people renewed and people covered today."""
    annual = policy.where(F.col("policy_status").isin(0, 1) & (F.col("charge_type") == ANNUAL))
    people = distinct_cover(cover.where(F.col("charge_type") == ANNUAL), carry=("policy_end",))

    def covered_on(day: Column) -> Column:
        return F.count_if((F.col("start") <= day) & (F.col("end") >= day))

    counts = people.groupBy("policy_id").agg(
        covered_on(F.date_sub("policy_end", 30)).alias("due_people"), covered_on(F.lit(as_of)).alias("current")
    )
    due_day = F.date_add("end_date", 1)
    return (
        annual.join(counts, "policy_id", "left")
        .join(renewed_people(annual, insured), "policy_id", "left")
        .select(
            "policy_id", "holder_name", "start_date", "end_date", due_day.alias("due_day"), month_id(due_day).alias("due_month"),
            F.concat(F.year(due_day).cast("string"), F.lit("-Q"), F.quarter(due_day).cast("string")).alias("due_quarter"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("current", "due_people", "renewed")],
        )
    )


def monthly_renewal(policy: DataFrame, endorsement: DataFrame) -> DataFrame:
    """Monthly policies, one row per month, with the renewal due after it and the endorsement that renewed it.

    The first month starts with the policy, the last one ends with it. The first month runs to its end even if the policy
    does not. ``endorsement`` has policy_id, preserve_start, preserve_end.
    """
    months = explode_months(
        policy.where(F.col("charge_type") == MONTHLY).select("policy_id", "holder_name", "start_date", "end_date"), "start_date", "end_date"
    )
    last = F.last_day("month")
    first_month = F.col("month") <= F.col("start_date")
    every = months.select(
        "policy_id",
        "holder_name",
        F.date_format(F.greatest("start_date", "month"), "yyyyMM").alias("effect_month"),
        month_id(F.date_add(last, 1)).alias("reference_month"),
        F.date_add(last, 1).alias("due_day"),
        F.greatest("start_date", "month").alias("start_day"),
        F.when(first_month, last).otherwise(F.least(last, F.col("end_date"))).alias("end_day"),
    )
    effective = F.coalesce("preserve_start", "preserve_end")
    actual = endorsement.groupBy("policy_id", month_id(effective).alias("reference_month")).agg(F.max(effective).alias("renewed_day"))
    return every.join(actual, ["policy_id", "reference_month"], "left")


def proposal_renewal(policy: DataFrame, as_of: date) -> DataFrame:
    """Monthly policies renewed by a successor: due the day after the end; judged on the successor's end or today, the earlier."""
    successor = policy.where(F.col("predecessor_id").isNotNull()).select(
        F.col("predecessor_id").alias("policy_id"), F.col("policy_id").alias("next_id"), F.col("end_date").alias("next_end")
    )
    return (
        policy.where(F.col("charge_type") == MONTHLY)
        .join(successor, "policy_id", "left")
        .select(
            "policy_id", "holder_name", "start_date", "end_date",
            F.date_add("end_date", 1).alias("due_day"),
            month_id(F.col("start_date")).alias("effect_month"),
            "next_id",
            F.when(F.col("next_end").isNotNull(), F.least("next_end", F.lit(as_of))).alias("renewed_day"),
        )
    )


def proposal_state() -> Column:
    """1 to submit, 2 to check, 3 unpaid, 4 not underwritten, 5 done, 6 expired, 8 other."""
    status, paid, ledger = F.col("status"), F.col("payment_status"), F.col("ledger_status")
    return (
        F.when(status.isin(1, 2), status)
        .when((status == 3) & (paid == 1), 3)
        .when((status == 3) & ledger.isin(1, 3) & (paid == 2), 4)
        .when(status == 5, 5)
        .when(status.isin(6, 7), 6)
        .otherwise(8)
    )


def endorsement_state() -> Column:
    return F.when(F.col("status") == 1, 1).when(F.col("status") == 3, 2).when(F.col("status") == 7, 5).otherwise(8)


def open_items(
    proposal: DataFrame, issued_policy: DataFrame, change: DataFrame, issued_endorsement: DataFrame, as_of: date, days: int = 5
) -> DataFrame:
    """Proposals and endorsements of the last days that are not in the issued tables yet."""
    recent = F.col("created") >= F.date_sub(F.lit(as_of), days)
    open_policies = (
        proposal.where(recent).join(issued_policy.select("policy_code"), "policy_code", "left_anti")
        .select("policy_code", F.lit(None).cast("string").alias("order_no"), "holder_name", proposal_state().alias("state"), "created", "people")
    )
    open_changes = (
        change.where(recent).join(issued_endorsement.select("order_no"), "order_no", "left_anti")
        .select("policy_code", "order_no", "holder_name", endorsement_state().alias("state"), "created", "people")
    )
    return open_policies.unionByName(open_changes)


def reference_days(as_of: date) -> dict[str, date]:
    """Reference, matching and current day. Up to the 5th: last month's end against this month's 5th; after it: today
    against next month's 5th."""
    first = as_of.replace(day=1)
    if as_of.day <= 5:
        return {"reference": first - timedelta(days=1), "matching": as_of.replace(day=5), "current": as_of}
    following = (first + timedelta(days=32)).replace(day=5)
    return {"reference": as_of, "matching": following, "current": as_of}


def renewal_reference_days(policy: DataFrame, cover: DataFrame, open_items: DataFrame, as_of: date) -> DataFrame:
    """Head-counts per policy on the reference, matching and current day, with the open items beside them."""
    counts = headcount_on(cover, {n: F.lit(d) for n, d in reference_days(as_of).items()})
    counted = policy.join(counts, "policy_id", "left").select(
        "policy_code", "holder_name", F.lit(7).alias("state"), "start_date", "reference", "matching", "current"
    )
    opened = open_items.select(
        "policy_code", "holder_name", "state", F.lit(0).cast("bigint").alias("reference"), F.col("people").cast("bigint").alias("matching"),
        F.lit(0).cast("bigint").alias("current"),
    )
    return counted.unionByName(opened, allowMissingColumns=True)


def daily_operator_detail(proposal: DataFrame, change: DataFrame, plan: DataFrame, as_of: date, next_day_insurers: str) -> DataFrame:
    """Proposals insured today before 18:00, and endorsements to take effect today or, for other insurers, tomorrow by 18:00.

    Where the policy is issued, its plan replaces the one proposed. ``next_day_insurers`` is a pattern of the insurers whose
    endorsements are taken on the day itself.
    """
    day = F.lit(as_of).cast("timestamp")

    def until_six(c: Column, shift: int) -> Column:
        start = day + F.make_dt_interval(days=F.lit(shift))
        return c.between(start, start + F.make_dt_interval(hours=F.lit(18)))

    today = F.col("insurer").like(next_day_insurers)
    new = proposal.where(until_six(F.col("insure_time"), 0)).select(
        "policy_id", "insurer", F.lit(4).alias("kind"), "sku_price", "sku_ratio", F.col("people").alias("add_people"), F.lit(0).alias("del_people"),
        "premium",
    )
    moved = change.where(F.when(today, until_six(F.col("effective_time"), 0)).otherwise(until_six(F.col("effective_time"), 1))).select(
        "policy_id", "insurer", F.lit(1).alias("kind"), "sku_price", "sku_ratio", "add_people", "del_people", "premium"
    )
    issued = plan.select("policy_id", F.lit(True).alias("issued"), F.col("sku_price").alias("i_price"), F.col("sku_ratio").alias("i_ratio"))
    override = {"sku_price": "i_price", "sku_ratio": "i_ratio"}
    return (
        new.unionByName(moved)
        .join(issued, "policy_id", "left")
        .withColumns({c: F.when(F.col("issued"), F.col(v)).otherwise(F.col(c)) for c, v in override.items()})
        .drop("issued", *override.values())
    )


def headcount_levels(cover: DataFrame, policy: DataFrame, key: str) -> DataFrame:
    """Total head-count of a group for each day any of its policies is in force."""
    people = distinct_cover(cover, carry=(key,)).select(key, "start", "end", F.lit(1).alias("n"))
    periods = policy.select(key, F.col("start_date").alias("start"), F.col("end_date").alias("end"), F.lit(0).alias("n"))
    runs = levels(people.unionByName(periods), [key], "start", "end", {"head_count": F.col("n")}).drop("active")
    return explode_days(runs, "from_day", "to_day").select(key, "day", "head_count")


def month_over_month_headcount(cover: DataFrame, policy: DataFrame, key: str = "insurer") -> DataFrame:
    """Head-count per insurer and day against the same day of the month before."""
    now = headcount_levels(cover, policy, key)
    before = now.select(key, F.col("day").alias("last_month_day"), F.col("head_count").alias("last_month_head_count"))
    return now.withColumn("last_month_day", F.add_months("day", -1)).join(before, [key, "last_month_day"])


def current_insured_mart(policy: DataFrame, plan: DataFrame, sellers: DataFrame, cover: DataFrame) -> DataFrame:
    """Policy, plan and enterprise with the head-count as runs of days; new customer is the enterprise's earliest start."""
    first = sellers.join(policy, F.col("ent_name") == F.col("holder_name")).groupBy("ent_name").agg(F.min("start_date").alias("first_start"))
    kind = F.when(F.col("channel_name") == F.col("ent_name"), "直客").otherwise("渠道")
    wide = (
        policy.drop("price")
        .join(plan.select("policy_id", "sku_price", "sku_coverage"), "policy_id")
        .join(sellers, F.col("holder_name") == F.col("ent_name"), "left")
        .join(first, "ent_name", "left")
        .withColumn("is_old", F.when(F.col("start_date") == F.col("first_start"), "新客").otherwise("老客"))
        .withColumn("customer_type", kind)
    )
    return wide.join(daily_headcount_runs(cover, policy), "policy_id")


def month_retention(policy: DataFrame, key: str) -> DataFrame:
    """Per month: customers in force, and how many are in force the next month too."""
    active = explode_months(policy.select(key, "start_date", "end_date"), "start_date", "end_date").select(key, "month").distinct()
    following = active.select(key, F.add_months("month", -1).alias("month"), F.lit(1).alias("stays"))
    return active.join(following, [key, "month"], "left").groupBy(month_id(F.col("month")).alias("month")).agg(
        F.count(F.lit(1)).alias("customers"), F.count("stays").alias("staying")
    )


def month_to_date_vs_last(ledger: DataFrame, as_of: date, measures: list[str]) -> DataFrame:
    """Sums of this month up to today and of last month up to the same day, and the growth. One pass, one row."""
    today, then = F.lit(as_of), F.add_months(F.lit(as_of), -1)
    this = F.col("day").between(F.trunc(today, "month"), today)
    last = F.col("day").between(F.trunc(then, "month"), then)
    sums = ledger.agg(
        *[F.sum(F.when(this, F.col(m))).alias(m) for m in measures], *[F.sum(F.when(last, F.col(m))).alias(f"last_{m}") for m in measures]
    )
    growth = {f"{m}_growth": ((F.col(m) - F.col(f"last_{m}")) / F.nullif(F.col(f"last_{m}"), F.lit(0))).cast("decimal(14,4)") for m in measures}
    return sums.withColumns(growth)


def daily_event_counts(log: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Log lines whose path holds a login or register address, per day and kind, and the total of each kind."""
    kind = None
    for name, path in kinds.items():
        found = F.col("path").contains(path)
        kind = F.when(found, name) if kind is None else kind.when(found, name)
    daily = log.withColumn("kind", kind).where(F.col("kind").isNotNull()).groupBy("kind", F.to_date("at").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return daily.unionByName(daily.groupBy("kind").agg(F.sum("n").alias("n")), allowMissingColumns=True)
