"""Premium movements, earned premium and head-counts.

Earned premium and head-counts are kept as runs of days with one level (see :func:`timeline.levels`), so no step holds a
row per person and day. :func:`timeline.explode_days` turns runs into days where a report wants them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverlake.operators.timeline import deltas, explode_days, levels, merge_intervals, runs

MONEY = "decimal(14,4)"

# Kinds of premium movement.
ADD_REMOVE, RENEWED, CANCELLED, NEW = 1, 2, 3, 4
MONTHLY, ANNUAL = 1, 2
DIRECT_CHANNEL = "直客"
LIVE_STATUSES = [0, 1, -1]


def zero_money(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast(MONEY)


def premium_ledger(policy: DataFrame, endorsement: DataFrame) -> DataFrame:
    """One row per premium movement: new and renewed policies, and the endorsements that took effect.

    ``policy`` carries ``predecessor`` as text: null means new, non-empty renewed. A cancelled policy stays a new or
    renewed one here; its refund arrives as a cancelling endorsement, counted in any status.
    """
    own = policy.where(F.col("policy_status").isin(LIVE_STATUSES)).withColumn(
        "premium_type", F.when(F.col("predecessor").isNull(), NEW).when(F.length("predecessor") > 0, RENEWED)
    )
    own = own.where(F.col("premium_type").isNotNull()).select(
        "policy_id",
        F.col("predecessor").alias("preserve_id"),
        "premium_type",
        zero_money(F.col("first_premium")).alias("add_premium"),
        F.coalesce("person_count", F.lit(0)).alias("add_person_count"),
        F.lit(0).cast(MONEY).alias("del_premium"),
        F.lit(0).alias("del_person_count"),
        F.col("start_date").alias("day"),
    )
    took_effect = (F.col("preserve_status") == 1) & F.col("preserve_type").isin(ADD_REMOVE, RENEWED)
    moved = (
        endorsement.where(took_effect | (F.col("preserve_type") == CANCELLED))
        .join(policy.select("policy_id"), "policy_id", "inner")
        .select(
            "policy_id",
            "preserve_id",
            F.col("preserve_type").alias("premium_type"),
            zero_money(F.col("add_premium")).alias("add_premium"),
            F.coalesce("add_person_count", F.lit(0)).alias("add_person_count"),
            zero_money(F.col("del_premium")).alias("del_premium"),
            F.coalesce("del_person_count", F.lit(0)).alias("del_person_count"),
            F.col("effective_date").alias("day"),
        )
    )
    return own.unionByName(moved).select(
        "*",
        (F.col("add_person_count") - F.col("del_person_count")).alias("sum_person"),
        (F.col("add_premium") + F.col("del_premium")).cast(MONEY).alias("sum_premium"),
    )


def ledger_enrich(
    ledger: DataFrame, policy: DataFrame, plan: DataFrame, sales: DataFrame, team: DataFrame, product: DataFrame
) -> DataFrame:
    """Movements with plan, sales team and product; a direct customer is its own channel."""
    sellers = (
        sales.join(team, sales.salesman == team.sale_name, "left")
        .select(
            "ent_name",
            F.when(F.col("channel_name") == DIRECT_CHANNEL, F.col("ent_name")).otherwise(F.col("channel_name")).alias("channel_name"),
            "salesman",
            "team_name",
        )
        .distinct()
    )
    plans = plan.select("policy_id", "sku_price", "sku_coverage", "sku_ratio", "sku_charge_type")
    # sellers are joined to the policies: the movements, many a policy, are then dealt by policy only, not by holder as well
    sold = (
        policy.select("policy_id", "holder_name", "product_code")
        .join(sellers, F.col("holder_name") == F.col("ent_name"), "left")
        .drop("ent_name")
    )
    wide = ledger.join(sold, "policy_id").join(plans, "policy_id", "left")
    names = [*ledger.columns, "holder_name", "product_code", *plans.columns, "channel_name", "salesman", "team_name"]
    return wide.select(*dict.fromkeys(names)).distinct().join(product, "product_code", "left")


def of_products(policy: DataFrame, product: DataFrame | None = None, line: str | None = None, excluded: Sequence[str] = ()) -> DataFrame:
    """Policies of one business line (of all without ``line``) but for the excluded product codes.

    A policy without a product code is of no line, and no exclusion meets it. What rests on the result, covers and claims
    joined to it among them, follows the choice.
    """
    kept = policy
    if excluded:
        kept = kept.where(F.coalesce(~F.col("product_code").isin(list(excluded)), F.lit(True)))
    if line is not None:
        if product is None:
            raise ValueError("a business line needs the product table")
        kept = kept.join(product.where(F.col("business_line") == line).select("product_code"), "product_code", "left_semi")
    return kept


def clamped_cover(insured: DataFrame, policy: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each insured person's cover cut to the policy period; a missing end falls back to the other one.

    ``carry`` names further policy columns to keep, which saves joining the policy again later.
    """
    s, e = F.coalesce("start_date", "end_date"), F.coalesce("end_date", "start_date")
    people = insured.withColumn("raw_start", s).withColumn("raw_end", e).drop("start_date", "end_date")
    periods = policy.select(
        "policy_id",
        F.col("start_date").alias("policy_start"),
        F.coalesce("end_date", "start_date").alias("policy_end"),
        "charge_type",
        "price",
        *carry,
    )
    return people.join(periods, "policy_id").select(
        *insured.drop("start_date", "end_date").columns,
        "policy_start",
        "policy_end",
        "charge_type",
        "price",
        *carry,
        F.greatest("raw_start", "policy_start").alias("cover_start"),
        F.least("raw_end", "policy_end").alias("cover_end"),
    ).where(F.col("cover_start") <= F.col("cover_end"))


def day_prices(cover: DataFrame, price: str = "price") -> DataFrame:
    """Adds ``day_price``: the price over the policy's days (annual) or over the person's own days (monthly).

    Rounded half up to the scale of the price, so day prices need not add up to the price.
    """
    days = F.when(
        F.col("charge_type") == ANNUAL, F.datediff("policy_end", "policy_start")
    ).otherwise(F.datediff("cover_end", "cover_start")) + 1
    return cover.withColumn("day_price", (F.col(price) / days).cast(MONEY))


def daily_price(cover: DataFrame, charge_type: int) -> DataFrame:
    """One row per person and day with its price, for one charge type."""
    priced = day_prices(cover.where(F.col("charge_type") == charge_type))
    return explode_days(priced.select("policy_id", "insured_id", "day_price", "cover_start", "cover_end"), "cover_start", "cover_end").select(
        "policy_id", "insured_id", "day", "day_price"
    )


def daily_premium_exploded(cover: DataFrame) -> DataFrame:
    """Premium by (policy, day), summed over exploded person-days. The plain form the runs are tested against."""
    rows = explode_days(day_prices(cover), "cover_start", "cover_end")
    return rows.groupBy("policy_id", "day").agg(F.sum(F.coalesce("day_price", F.lit(0))).alias("premium"))


def daily_premium_runs(cover: DataFrame) -> DataFrame:
    """Premium by policy as runs of days: two rows per person instead of one per day."""
    return levels(day_prices(cover), ["policy_id"], "cover_start", "cover_end", {"premium": zero_money(F.col("day_price"))})


def daily_premium(cover: DataFrame) -> DataFrame:
    """Premium by (policy, day)."""
    return explode_days(daily_premium_runs(cover), "from_day", "to_day").select("policy_id", "day", "premium")


def distinct_cover(cover: DataFrame, person: str = "cert_no", carry: tuple[str, ...] = ()) -> DataFrame:
    """Disjoint cover periods per (policy, person): whoever is listed twice on a day counts once."""
    return merge_intervals(cover.where(F.col(person).isNotNull()), ["policy_id", person, *carry], "cover_start", "cover_end")


def daily_headcount_runs(cover: DataFrame, policy: DataFrame, person: str = "cert_no") -> DataFrame:
    """Distinct insured people per policy as runs of days over the whole policy period, zeros included."""
    people = distinct_cover(cover, person).select(
        "policy_id", "start", "end", F.lit(1).alias("n")
    )
    periods = policy.select(
        "policy_id", F.col("start_date").alias("start"), F.coalesce("end_date", "start_date").alias("end"), F.lit(0).alias("n")
    )
    return levels(people.unionByName(periods), ["policy_id"], "start", "end", {"head_count": F.col("n")}).drop("active")


def person_days(insured: DataFrame, as_of: date) -> DataFrame:
    """Days covered so far per policy: least(end, today) - start + 1, nothing if start is after that."""
    last = F.least(F.coalesce("end_date", "start_date"), F.lit(as_of))
    start = F.coalesce("start_date", "end_date")
    days = F.when(start <= last, F.datediff(last, start) + 1).otherwise(0)
    return insured.groupBy("policy_id").agg(F.sum(days).alias("person_days"))


def earned_to_date(cover: DataFrame, policy: DataFrame, as_of: date) -> DataFrame:
    """Premium earned before ``as_of`` per policy, zero where none is.

    A person earns its day price on each covered day, so the sum is price times days: no day is ever exploded.
    """
    last = F.least("cover_end", F.date_sub(F.lit(as_of), 1))
    days = F.when(F.col("cover_start") <= last, F.datediff(last, "cover_start") + 1).otherwise(0)
    earned = day_prices(cover).groupBy("policy_id").agg(F.sum(F.coalesce("day_price", F.lit(0)) * days).alias("earned"))
    return policy.join(earned, "policy_id", "left").select(
        *policy.columns, F.coalesce("earned", F.lit(0)).cast("decimal(20,4)").alias("earned_premium")
    )


def earned_between(cover: DataFrame, first: date | None, last: date, name: str) -> DataFrame:
    """Premium earned per policy on days first..last (None: from the beginning); policies that earn nothing before ``last`` have no row."""
    start = F.col("cover_start") if first is None else F.greatest("cover_start", F.lit(first))
    end = F.least("cover_end", F.lit(last))
    days = F.when(start <= end, F.datediff(end, start) + 1).otherwise(0)
    return (
        day_prices(cover.where(F.col("cover_start") <= F.lit(last)))
        .groupBy("policy_id")
        .agg(F.sum(F.coalesce("day_price", F.lit(0)) * days).alias(name))
    )


def exposure_to_date(cover: DataFrame, as_of: date) -> DataFrame:
    """Per policy: distinct people covered today, and person-days up to today."""
    upto = F.least("end", F.lit(as_of))
    return (
        distinct_cover(cover)
        .where(F.col("start") <= F.lit(as_of))
        .groupBy("policy_id")
        .agg(
            F.count_if(F.col("end") >= F.lit(as_of)).alias("curr_insured"),
            F.sum(F.datediff(upto, "start") + 1).alias("person_count"),
        )
    )


def current_month_summary(
    policy: DataFrame, headcount_today: DataFrame, accounts: DataFrame, as_of: date, gig_line: str = "零工保"
) -> DataFrame:
    """Today's head-count and this month's booked premium by insurer, charge type and new or old customer.

    ``policy`` needs insurer, charge_type, consumer_new_old, two_level; ``accounts`` policy_id, day, premium.
    """
    today = F.lit(as_of)
    booked = (
        accounts.where(F.col("day").between(F.trunc(today, "month"), today))
        .groupBy("policy_id")
        .agg(F.sum("premium").alias("premium"))
    )
    charge = F.coalesce("charge_type", F.lit(MONTHLY))
    return (
        policy.join(headcount_today, "policy_id", "left")
        .join(booked, "policy_id", "left")
        .groupBy(
            "insurer",
            F.when(charge == MONTHLY, "月单").when(charge.isin(ANNUAL, 4), "年单").alias("charge"),
            F.coalesce("consumer_new_old", F.lit("old")).alias("consumer_new_old"),
        )
        .agg(
            F.sum(F.when(F.col("two_level") == gig_line, 0).otherwise(F.coalesce("head_count", F.lit(0)))).alias("head_count"),
            F.sum(zero_money(F.col("premium"))).alias("premium"),
        )
    )


def latest_statistic_per_day(stats: DataFrame) -> DataFrame:
    """Of the snapshots sent for a (product, day) keep the one with the highest id."""
    rest = [c for c in stats.columns if c not in ("product", "day", "id")]
    return (
        stats.groupBy("product", "day")
        .agg(F.max_by(F.struct("id", *rest), "id").alias("row"))
        .select("product", "day", "row.*")
    )


def product_day_premium(ledger: DataFrame, statistics: DataFrame) -> DataFrame:
    """Count and premium by product line, movement type and day, from the ledger and from partners' statistics."""
    own = (
        ledger.groupBy(F.col("one_level").alias("line"), "day", "premium_type")
        .agg(F.count(F.lit(1)).alias("policy_count"), F.sum("sum_premium").alias("premium"))
        .withColumn("source", F.lit("官网"))
    )
    partner = (
        statistics.groupBy(F.col("product").alias("line"), "day", "premium_type")
        .agg(F.sum("policy_count").alias("policy_count"), F.sum("premium").alias("premium"))
        .withColumn("source", F.lit("接口"))
    )
    return own.unionByName(partner)


def exposure_changes(cover: DataFrame, keys: Sequence[str], person: str = "cert_no") -> DataFrame:
    """People, premium and expiring premium as changes per day, from one pass over the covers.

    Covers shrink to one row per (policy, person, first day, last day). In a person's order of covers, one that starts a
    day or more after everything before it has ended opens a new stay: it counts the person in, and the stay before it
    out. Returns keys, ``day``, ``people``, ``premium``, ``priced`` (covers with a price) and ``expired``, the premium of the
    covers booked on the policy's end day. ``keys`` are columns the policy determines.
    """
    group = list(dict.fromkeys(["policy_id", *keys, "policy_end"]))
    spans = day_prices(cover).groupBy(*group, person, "cover_start", "cover_end").agg(
        F.sum(zero_money(F.col("day_price"))).alias("price"), F.count(F.lit(1)).alias("covers")
    )
    # people without a certificate are no stays: they need no order, and one policy may list very many
    in_order = Window.partitionBy(*group, person, "_lot").orderBy("cover_start", "cover_end")
    reach = F.max("cover_end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    known = F.col(person).isNotNull()
    lot = F.when(~known, F.unix_date("cover_start"))
    seen = spans.withColumn("_lot", lot).withColumns({"reach": reach, "next_start": F.lead("cover_start").over(in_order)})
    opens = known & (F.col("reach").isNull() | (F.col("cover_start") > F.date_add("reach", 1)))
    closes_before = opens & F.col("reach").isNotNull()
    closes = known & F.col("next_start").isNull()
    days = F.datediff("cover_end", "cover_start") + 1
    none, money = F.lit(0), F.lit(0).cast("decimal(24,4)")

    def change(day: Column, people: Column = none, premium: Column = money, priced: Column = none, expired: Column = money) -> Column:
        return F.struct(
            day.alias("day"), people.cast("int").alias("people"), premium.cast("decimal(24,4)").alias("premium"),
            priced.cast("bigint").alias("priced"), expired.cast("decimal(24,4)").alias("expired"),
        )

    changes = F.array(
        change(F.col("cover_start"), opens, F.col("price"), F.col("covers")),
        change(F.date_add("cover_end", 1), none, -F.col("price"), -F.col("covers")),
        change(F.col("policy_end"), expired=F.col("price") * days),
        F.when(closes_before, change(F.date_add("reach", 1), F.lit(-1))),
        F.when(closes, change(F.date_add(F.greatest("reach", "cover_end"), 1), F.lit(-1))),
    )
    return seen.select(*keys, F.inline(F.array_compact(changes)))


def insured_premium_runs(cover: DataFrame, policy: DataFrame) -> DataFrame:
    """Head-count and premium side by side per policy day, as runs; premium is null on days nobody is priced.

    Both measures ride on one set of day changes, which saves the join on (policy, day).
    """
    measures = ["people", "premium", "priced"]
    covered = exposure_changes(cover, ["policy_id"]).drop("expired").withColumn("active", F.lit(0))
    period = deltas(policy, ["policy_id"], "start_date", "end_date", {m: F.lit(0) for m in measures})
    levelled = runs(covered.unionByName(period), ["policy_id"], measures)
    return levelled.select(
        "policy_id", "from_day", "to_day", F.col("people").alias("head_count"), F.when(F.col("priced") > 0, F.col("premium")).alias("premium")
    )


def headcount_by(cover: DataFrame, policy: DataFrame, keys: list[str], as_of: date) -> DataFrame:
    """Runs of the total head-count of a group of policies, up to today."""
    upto = F.least("end", F.lit(as_of))
    people = distinct_cover(cover).withColumn("end", upto).join(policy.select("policy_id", *keys), "policy_id")
    return levels(people, keys, "start", "end", {"head_count": F.lit(1)}).drop("active")


def peak_and_cumulative_headcount(cover: DataFrame, policy: DataFrame, as_of: date) -> DataFrame:
    """Per holder: peak daily head-count, its channel's peak, person-days so far and earned premium so far."""
    def summary(key: str, peak: str) -> DataFrame:
        counted = headcount_by(cover, policy, [key], as_of)
        return counted.groupBy(key).agg(
            F.max("head_count").alias(peak),
            F.sum(F.col("head_count") * (F.datediff("to_day", "from_day") + 1)).alias(f"{peak}_days"),
        )

    holder = summary("holder_name", "holder_peak").withColumnRenamed("holder_peak_days", "cumulative")
    channel = summary("channel", "channel_peak").drop("channel_peak_days")
    earned = (
        earned_to_date(cover, policy, as_of)
        .groupBy("holder_name", "channel")
        .agg(F.sum("earned_premium").alias("earned_premium"))
    )
    return earned.join(holder, "holder_name", "left").join(channel, "channel", "left")


def supplement_premium(work: DataFrame, policy: DataFrame, reference_price: DataFrame, as_of: date) -> DataFrame:
    """Premium missed because people work in a class above the plan's top class, per policy up to today.

    ``work`` is one row per insured person with class, top class of the plan and the cover's dates; ``reference_price``
    gives the monthly price of the class the person really needs. The shortfall is never negative.
    """
    shortfall = F.when(
        (F.col("work_class") > F.col("grade_high")) & (F.col("reference") > F.col("price")), F.col("reference") - F.col("price")
    ).otherwise(0)
    annual = F.when(F.col("charge_type") == ANNUAL, F.col("avg_price") * 12).otherwise(F.col("avg_price"))
    cover = clamped_cover(work, policy).join(reference_price, "work_class", "left")
    priced = day_prices(
        cover.withColumn("reference", annual.cast(MONEY)).withColumn("shortfall", shortfall.cast(MONEY)), "shortfall"
    )
    last = F.least("cover_end", F.lit(as_of))
    days = F.when(F.col("cover_start") <= last, F.datediff(last, "cover_start") + 1)
    return (
        priced.where(days.isNotNull())
        .groupBy("policy_id")
        .agg(F.sum(F.coalesce("day_price", F.lit(0)) * days).cast("decimal(24,10)").alias("supplement_premium"))
    )


