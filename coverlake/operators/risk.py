"""Risk monitoring over policies, exposure and claims."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverlake.operators.claims import SETTLED
from coverlake.operators.premium import ANNUAL, day_prices, distinct_cover, earned_between, exposure_changes, exposure_to_date, zero_money
from coverlake.operators.timeline import day_labels, deltas, explode_days, levels, runs

MONEY = "decimal(14,4)"
GROUP = ("channel", "insurer", "charge_type")
FLOWS = ["ledger_premium", "cases", "settled", "payable", "expired_premium", "expired_claims"]
LEVELS = ["head_count", "earned_premium"]

# Loss-ratio bounds of classes A and B.
LOSS_A, LOSS_B = 0.7, 1.3


def risk_monitor(
    policy: DataFrame, cover: DataFrame, ledger: DataFrame, claim: DataFrame, as_of: date
) -> DataFrame:
    """Exposure, premium, claims and expiry by (channel, insurer, charge type, day) with running totals.

    ``cover`` carries the group columns. A policy contributes from its first day to its end, and with zeros on to today.
    Movements and claims count on days inside the policy period. Levels and flows are changes on one day axis: they are
    summed per group and day once, and the only rows per day are those of the result.
    """
    keys = list(GROUP)
    period = policy.where(F.col("channel").isNotNull()).select(
        "policy_id", *keys, "start_date", F.coalesce("end_date", "start_date").alias("end_date")
    )
    money = "decimal(24,4)"
    types = {"head_count": "bigint", "earned_premium": money, **{m: "bigint" if m == "cases" else money for m in FLOWS}}

    def changes(df: DataFrame, **measures: Column) -> DataFrame:
        """Rows of (keys, day, active, measures), zero where nothing is given."""
        given = {"active": F.lit(0), **measures}
        return df.select(
            *keys, "day", given["active"].alias("active"), *[given.get(m, F.lit(0)).cast(t).alias(m) for m, t in types.items()]
        )

    def in_period(df: DataFrame, day: str) -> DataFrame:
        return df.join(period, "policy_id").where(F.col(day).between(F.col("start_date"), F.col("end_date")))

    known = deltas(period.withColumn("until", F.greatest("end_date", F.lit(as_of))), keys, "start_date", "until", {})
    exposed = exposure_changes(cover.where(F.col("channel").isNotNull()), keys)
    moved = in_period(ledger.select("policy_id", "day", "sum_premium"), "day")
    claimed = in_period(claim.select("policy_id", "risk_day", "payable", "case_status"), "risk_day")
    settled = F.when(F.col("case_status") == SETTLED, F.col("payable")).otherwise(0)
    booked = claimed.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("risk_day").alias("day"), F.lit(1).alias("n"), F.col("payable").alias("paid"), settled.alias("done"), F.lit(0).cast(MONEY).alias("due")),
                F.struct(F.col("end_date").alias("day"), F.lit(0).alias("n"), F.lit(0).cast(MONEY).alias("paid"), F.lit(0).cast(MONEY).alias("done"), F.col("payable").alias("due")),
            )
        ),
    )
    whole = (
        changes(known, active=F.col("active"))
        .unionByName(changes(exposed, head_count=F.col("people"), earned_premium=F.col("premium"), expired_premium=F.col("expired")))
        .unionByName(changes(moved, ledger_premium=F.coalesce("sum_premium", F.lit(0))))
        .unionByName(changes(booked, cases=F.col("n"), payable=F.col("paid"), settled=F.col("done"), expired_claims=F.col("due")))
    )
    days = explode_days(runs(whole, keys, LEVELS, FLOWS), "from_day", "to_day")
    upto = Window.partitionBy(*keys).orderBy("day")
    filled = days.select(
        *keys, "day", *LEVELS, *[F.when(F.col("day") == F.col("from_day"), F.col(m)).otherwise(0).alias(m) for m in FLOWS]
    )
    running = filled.select("*", *[F.sum(m).over(upto).alias(f"acc_{m}") for m in [*LEVELS, *FLOWS]])
    labels = day_labels(F.col("day"))
    return running.withColumns(
        {
            "week_id": labels["c_week_id"],
            "week_day": F.when(labels["week_day"] == 5, "星期五"),
            "month_id": labels["c_month_id"],
            "month_end": F.when(labels["c_month_end_date"] == F.col("day"), F.col("day")),
        }
    )


def risk_monitor_today(
    policy: DataFrame, cover: DataFrame, ledger: DataFrame, claim: DataFrame, as_of: date,
    exposure: DataFrame | None = None, earned: DataFrame | None = None,
) -> DataFrame:
    """The rows of :func:`risk_monitor` for one day, without the others: head-count and running totals per group.

    Totals up to a day need no days: a level adds up to its value times its days so far, a flow to what is dated so far.
    Everything is summed per policy first, and the group columns come from the policy. A caller that has ``exposure``
    (:func:`exposure_to_date`) and ``earned`` (:func:`earned_between` from the beginning, as ``earned_premium``) of the same
    cover and day hands them in.
    """
    today, money = F.lit(as_of), "decimal(24,4)"
    period = policy.where(F.col("channel").isNotNull() & (F.col("start_date") <= today)).select(
        "policy_id", *GROUP, "start_date", F.coalesce("end_date", "start_date").alias("end_date")
    )
    ended = F.col("end_date") <= today
    dates = period.select("policy_id", "start_date", "end_date")

    def so_far(df: DataFrame, day: str) -> DataFrame:
        return df.join(dates, "policy_id").where(F.col(day).between(F.col("start_date"), F.least("end_date", today)))

    exposure = exposure_to_date(cover, as_of) if exposure is None else exposure
    people = exposure.select("policy_id", F.col("curr_insured").alias("head_count"), F.col("person_count").alias("acc_head_count"))
    earned = earned_between(cover, None, as_of, "earned_premium") if earned is None else earned
    earned = earned.select("policy_id", F.col("earned_premium").alias("acc_earned_premium"))
    price = zero_money(F.col("day_price")) * (F.datediff("cover_end", "cover_start") + 1)
    expired = day_prices(cover.where(F.col("policy_end") <= today)).groupBy("policy_id").agg(F.sum(price).alias("acc_expired_premium"))
    moved = so_far(ledger.select("policy_id", "day", "sum_premium"), "day").groupBy("policy_id").agg(F.sum("sum_premium").alias("acc_ledger_premium"))
    settled = F.when(F.col("case_status") == SETTLED, F.col("payable"))
    claims = so_far(claim.select("policy_id", "risk_day", "payable", "case_status"), "risk_day").groupBy("policy_id").agg(
        F.count(F.lit(1)).alias("acc_cases"), F.sum("payable").alias("acc_payable"), F.sum(settled).alias("acc_settled"),
        F.sum(F.when(ended, F.col("payable"))).alias("acc_expired_claims"),
    )
    whole = period
    for part in (people, earned, expired, moved, claims):
        whole = whole.join(part, "policy_id", "left")
    counts, sums = ["head_count", "acc_head_count", "acc_cases"], [
        "acc_earned_premium", "acc_ledger_premium", "acc_payable", "acc_settled", "acc_expired_premium", "acc_expired_claims"]
    return whole.groupBy(*GROUP).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
        *[F.coalesce(F.sum(c), F.lit(0)).cast(money).alias(c) for c in sums],
    )


def class_mix(work: DataFrame) -> DataFrame:
    """People per risk class, per policy; ``other`` is whoever falls in no class and is not marked unknown."""
    classes = ["one", "two", "three", "four", "five", "six"]
    counts = [F.count_if(F.col("work_risk") == str(i + 1)).alias(f"{name}_risk") for i, name in enumerate(classes)]
    unknown = F.count_if(F.col("work_name_check") == "未知").alias("unknown_risk")
    mix = work.groupBy("policy_id").agg(*counts, unknown, F.count("work_type").alias("work_counts"))
    listed = sum((F.col(f"{c}_risk") for c in classes), F.col("unknown_risk"))
    return mix.withColumn("other_risk", F.col("work_counts") - listed)


def risk_features(
    policy: DataFrame, work: DataFrame, claim: DataFrame, earned: DataFrame, insured: DataFrame
) -> DataFrame:
    """Per policy: class counts and the cases, earned premium, people and pay of its predecessors 1, 2 and 3 back.

    The chain is followed on ids alone. Each policy then asks one table of facts for itself and its three predecessors,
    so the facts are built and shuffled once.
    """
    claims = claim.groupBy("policy_id").agg(F.count("case_no").alias("cases"), F.sum("payable").alias("payable"))
    people = insured.groupBy("policy_id").agg(F.count("cert_no").alias("people"))
    own = (
        policy.select("policy_id", "predecessor_id", "person_count", "price")
        .join(claims, "policy_id", "left")
        .join(earned.select("policy_id", "earned_premium"), "policy_id", "left")
        .join(people, "policy_id", "left")
        .join(class_mix(work), "policy_id", "left")
    )

    links = policy.select("policy_id", "predecessor_id")
    first, second = (links.select(F.col("policy_id").alias(f"id_{n}"), F.col("predecessor_id").alias(f"before_{n}")) for n in (1, 2))
    chain = (
        links.join(first, F.col("predecessor_id") == F.col("id_1"), "left").join(second, F.col("before_1") == F.col("id_2"), "left")
    )
    steps = ["policy_id", "predecessor_id", "before_1", "before_2"]
    asked = chain.select(
        "policy_id", F.inline(F.array(*[F.struct(F.lit(k).alias("back"), F.col(c).alias("id")) for k, c in enumerate(steps)]))
    ).where(F.col("id").isNotNull())

    def at(back: int, column: str, name: str) -> Column:
        return F.max(F.when(F.col("back") == back, F.col(column))).alias(name)

    looked_up = {
        "one_cases": (1, "cases"), "one_earned": (1, "earned_premium"), "parent_work_counts": (1, "work_counts"),
        "parent_three_risk": (1, "three_risk"), "two_people": (2, "people"), "three_payable": (3, "payable"),
    }
    facts = own.withColumnRenamed("policy_id", "id")
    return asked.join(facts, "id").groupBy("policy_id").agg(
        *[at(0, c, c) for c in own.columns if c != "policy_id"], *[at(k, c, name) for name, (k, c) in looked_up.items()]
    )


def ratio(top: Column, bottom: Column) -> Column:
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def target_tracking(
    policy: DataFrame, work: DataFrame, exposure: DataFrame, earned: DataFrame, claim: DataFrame, since: date
) -> DataFrame:
    """Per policy: class mix, exposure, claims by kind, and the channel's own location where the channel is a holder.

    ``policy`` has channel_name, holder_name, province, city; ``exposure`` person_count and curr_insured; ``earned``
    earned_premium and earned_since.
    """
    latest = (
        policy.groupBy("channel_name", "holder_name")
        .agg(F.max_by(F.struct("province", "city"), F.struct("start_date", "policy_id")).alias("at"))
        .select(F.col("holder_name").alias("seat"), F.col("at.province").alias("channel_province"), F.col("at.city").alias("channel_city"))
        .distinct()
    )
    dead, disabled = F.col("case_type") == "死亡", F.col("case_type") == "伤残"
    none = F.lit(0).cast(MONEY)
    claims = claim.groupBy("policy_id").agg(
        F.sum("payable").alias("payable"),
        F.count("case_no").alias("cases"),
        F.sum(F.when(dead, F.col("payable")).otherwise(none)).alias("dead_payable"),
        F.sum(F.when(disabled, F.col("payable")).otherwise(none)).alias("disabled_payable"),
        F.count_if(dead).alias("dead_cases"),
        F.count_if(disabled).alias("disabled_cases"),
        F.sum(F.when(F.col("risk_day") >= F.lit(since), F.col("payable")).otherwise(none)).alias("payable_since"),
    )
    mix = class_mix(work).drop("unknown_risk", "other_risk", "work_counts")
    return (
        policy.join(mix, "policy_id", "left")
        .join(latest, F.col("channel_name") == F.col("seat"), "left")
        .drop("seat")
        .join(exposure, "policy_id", "left")
        .join(earned, "policy_id", "left")
        .join(claims, "policy_id", "left")
    )


def target_channels(base: DataFrame, as_of: date, since: date) -> DataFrame:
    """Per channel: loss class, maturity (six months) and whether it is a new customer."""
    loss = ratio(F.coalesce(F.sum("payable"), F.lit(0)), F.sum("earned_premium"))
    return (
        base.where(F.col("earned_premium") > 0)
        .groupBy("channel_name")
        .agg(
            F.min("start_date").alias("first_day"),
            F.when(loss <= LOSS_A, "A").when(loss <= LOSS_B, "B").when(loss > LOSS_B, "C").alias("loss_class"),
        )
        .select(
            "*",
            F.when(F.months_between(F.lit(as_of), F.col("first_day")) >= 6, "是").otherwise("否").alias("mature"),
            F.when(F.col("first_day") >= F.lit(since), "新客").otherwise("老客").alias("customer_kind"),
        )
    )


def target_months(cover: DataFrame, claim: DataFrame, key: str) -> DataFrame:
    """Per channel and ten-day period: premium earned, and claims paid on days that earned premium.

    Premium is spread per channel; claims count where their policy was earning on that day.
    """
    runs = levels(day_prices(cover), [key], "cover_start", "cover_end", {"earned": zero_money(F.col("day_price"))})

    def period(day: str) -> list[Column]:
        labels = day_labels(F.col(day))
        return [labels["c_ten_day_id"].alias("ten_day"), labels["c_month_id"].alias("month")]

    earned = explode_days(runs, "from_day", "to_day").groupBy(key, *period("day")).agg(F.sum("earned").alias("earned"))
    facts = claim.where(F.col("risk_day").isNotNull()).groupBy("policy_id", "risk_day").agg(F.sum("payable").alias("payable"))
    earning = (
        distinct_cover(cover.withColumn("all", F.lit("all")), "all", (key,)).select("policy_id", key, "start", "end")
    )
    paid = (
        facts.join(earning, "policy_id")
        .where(F.col("risk_day").between(F.col("start"), F.col("end")))
        .groupBy(key, *period("risk_day"))
        .agg(F.sum("payable").alias("payable"))
    )
    return earned.join(paid, [key, "ten_day", "month"], "left")


def claim_analysis(
    policy: DataFrame, work: DataFrame, claim: DataFrame, exposure: DataFrame, earned: DataFrame, since: date
) -> DataFrame:
    """Per policy: shares of risk classes, genders and age bands, first-policy flag, new or old channel, claims, premium."""
    gs = F.col("gs_work_risk")
    classed = F.count_if(gs >= 0)
    sexed, listed = F.count_if(F.col("gender").isin(0, 1)), F.count("cert_no")
    names = ["one", "two", "three", "four", "five"]
    bands = [("under_16", (F.col("age") > 0) & (F.col("age") < 16)), ("under_25", F.col("age").between(16, 24)),
             ("under_36", F.col("age").between(25, 35)), ("under_45", F.col("age").between(36, 44)),
             ("under_55", F.col("age").between(45, 54)), ("over_55", F.col("age") >= 55)]
    shares = work.groupBy("policy_id").agg(
        *[ratio(F.count_if(gs == i + 1), classed).alias(f"{n}_rate") for i, n in enumerate(names)],
        ratio(F.count_if(gs.isin(6, 0)), classed).alias("six_rate"),
        ratio(F.count_if(F.col("gender") == 1), sexed).alias("man_rate"),
        ratio(F.count_if(F.col("gender") == 0), sexed).alias("woman_rate"),
        *[ratio(F.count_if(c), listed).alias(n) for n, c in bands],
    )
    channel = policy.groupBy("channel").agg(
        F.when(F.min("start_date") >= F.lit(since), "新客").otherwise("老客").alias("channel_kind")
    )
    first = policy.groupBy("holder_name").agg(F.min_by("policy_id", F.struct("start_date", "policy_id")).alias("first_id"))
    claims = claim.groupBy("policy_id").agg(F.count("case_no").alias("cases"), F.sum("payable").alias("payable"))
    monthly = F.when(F.col("charge_type") == ANNUAL, (F.col("price") / 12).cast(MONEY)).otherwise(F.col("price"))
    return (
        policy.withColumn("month_price", monthly)
        .join(shares, "policy_id", "left")
        .join(channel, "channel", "left")
        .join(first.select(F.col("first_id").alias("policy_id"), F.lit("1").alias("first_policy")), "policy_id", "left")
        .join(claims, "policy_id", "left")
        .join(exposure, "policy_id", "left")
        .join(earned, "policy_id", "left")
    )


def claim_list(claim: DataFrame, work: DataFrame) -> DataFrame:
    """Claims of policies with insured people, each with the latest work type known of the person on that policy."""
    latest = work.groupBy("policy_id", F.col("cert_no").alias("risk_cert_no")).agg(
        F.max_by(F.struct("work_type"), F.struct("start_date", "insured_id")).alias("at")
    ).select("policy_id", "risk_cert_no", F.col("at.work_type").alias("work_type"))
    listed = work.select("policy_id").distinct()
    return claim.join(listed, "policy_id", "left_semi").join(latest, ["policy_id", "risk_cert_no"], "left")


def plan_work_type(work_claim: DataFrame, as_of: date) -> DataFrame:
    """Plans by work type: people covered today, claims and premium, and the channel's people in all its plans.

    The channel total is a second aggregate joined back, so no channel is ever sorted as one window.
    """
    monthly = F.when(F.col("charge_type") == ANNUAL, (F.col("price") / 12).cast(MONEY)).otherwise(F.col("price"))
    covered = F.lit(as_of).between(F.col("start_date"), F.col("end_date"))
    names = F.array(*[F.lit(n) for n in ["一类", "二类", "三类", "四类", "五类", "六类", "七类"]])
    risk = F.col("work_risk").try_cast("int")
    plans = work_claim.groupBy(
        "channel",
        "insurer",
        "profession_type",
        F.when(F.col("charge_type") == 1, "月单").when(F.col("charge_type") == 2, "年单").otherwise("其他").alias("charge"),
        F.concat(F.col("sku_coverage").cast("decimal(14,0)").cast("string"), F.lit("万")).alias("coverage"),
        F.when(F.col("sku_ratio") == "1", "5%").when(F.col("sku_ratio") == "2", "10%").alias("ratio"),
        monthly.alias("month_price"),
        "work_type",
        F.when(risk.between(1, 7), F.element_at(names, risk)).alias("risk_name"),
    ).agg(
        F.count_if(covered).alias("curr_insured"),
        F.sum("payable").alias("payable"),
        F.sum(F.coalesce("earned", F.lit(0))).alias("earned"),
    )
    totals = work_claim.groupBy("channel").agg(F.count_if(covered).alias("all_curr_insured"))
    return plans.join(totals, "channel", "left")


def channel_overlap(people: DataFrame, monitor_today: DataFrame, watch_list: DataFrame) -> DataFrame:
    """Share of a (channel, operator, salesman)'s insured people who also appear under another channel.

    Whether a person has two channels is read off the smallest and the largest one, so no pairs are formed. Black list
    beats grey list.
    """
    grain = ["channel", "biz_operator", "salesman"]
    seen = people.where(F.col("cert_no").isNotNull() & F.col("channel").isNotNull()).select("cert_no", *grain).distinct()
    shared = seen.groupBy("cert_no").agg((F.min("channel") != F.max("channel")).alias("elsewhere"))
    share = seen.join(shared, "cert_no").groupBy(*grain).agg(
        ratio(F.count_if("elsewhere"), F.count(F.lit(1))).alias("overlap")
    )
    today = monitor_today.groupBy("channel").agg(
        F.sum("head_count").alias("curr_insured"),
        F.coalesce(ratio(F.sum("acc_payable"), F.sum("acc_earned_premium")), F.lit(0.0)).alias("loss_rate"),
        ratio(F.sum("acc_cases") * 365, F.sum("acc_head_count")).alias("risk_rate"),
    )
    listed = watch_list.groupBy(F.col("ent_name").alias("channel")).agg(F.min("colour").alias("colour"))
    return (
        share.join(listed, "channel", "left")
        .join(today, "channel", "left")
        .withColumn("list_flag", F.coalesce("colour", F.lit(0)))
        .drop("colour")
    )
