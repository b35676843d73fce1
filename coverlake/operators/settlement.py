"""Settlement accounts and sales performance."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlake.functions.text import mask_name, no_line_breaks
from coverlake.operators.premium import zero_money

MONEY = "decimal(14,4)"
LIVE_STATUSES = [0, 1, -1]
GIG_LINE = "零工保"
EMPLOYER = "雇主"
COMPANY = "公司"

# Disability ratio by plan code, settlement code of an endorsement type and of a payment state.
DISABILITY_RATIO = {"1": "0.05", "2": "0.1"}
ENDORSEMENT_CODE = {1: "0", 2: "2", 3: "5"}
PAYMENT_CODE = {1: "0", 2: "1", 3: "3"}

ACCOUNT_COLUMNS = [
    "policy_code", "preserve_id", "product_code", "product_name", "channel_name", "business_owner", "business_region",
    "business_source", "operator_name", "business_type", "accounting_day", "holder_name", "plan_price", "disability_rate", "pay_type",
    "insurer", "effective_day", "expire_day", "policy_status", "premium_total", "economy_rate", "economy_fee", "technical_rate",
    "technical_fee", "brokerage_ratio", "brokerage_fee", "payment",
]


def code_of(c: Column, codes: dict, default: Column | None = None) -> Column:
    out = None
    for key, value in codes.items():
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return out.otherwise(c.cast("string") if default is None else default)


def disability_rate(ratio: Column) -> Column:
    return F.when(ratio.isNull(), "0").otherwise(code_of(ratio, DISABILITY_RATIO)).try_cast("decimal(6,2)")


def _fees(premium: Column) -> dict[str, Column]:
    tech, broker = zero_money(F.col("tech_rate")), F.col("broker_rate")
    share = zero_money(F.col("commission_discount_rate"))
    return {
        "premium_total": premium.cast(MONEY),
        "economy_rate": broker.cast(MONEY),
        "economy_fee": (premium * broker).cast(MONEY),
        "technical_rate": tech,
        "technical_fee": (premium * tech).cast(MONEY),
        "brokerage_ratio": share,
        "brokerage_fee": (premium * share).cast(MONEY),
    }


def _accounts(rows: DataFrame, sellers: DataFrame, plan: DataFrame, product: DataFrame, lines: Sequence[str]) -> DataFrame:
    """Rows of the chosen product lines with plan, seller and product."""
    chosen = product.where(F.col("two_level").isin(list(lines))).select("product_code", "product_name", "two_level")
    return (
        rows.where(F.col("policy_status").isin(LIVE_STATUSES))
        .join(chosen, "product_code")
        .join(plan.drop("product_code"), "policy_id", "left")
        .join(sellers, F.col("holder_name") == F.col("ent_name"), "left")
    )


def _common() -> dict[str, Column]:
    return {
        "business_owner": F.col("salesman"),
        "business_region": F.col("team_name"),
        "operator_name": F.col("biz_operator"),
        "plan_price": F.col("sku_price"),
        "disability_rate": disability_rate(F.col("sku_ratio")),
        "pay_type": F.when(F.col("two_level") == GIG_LINE, "3").otherwise(F.col("sku_charge_type").cast("string")),
        "policy_status": F.col("policy_status").cast("string"),
    }


def settlement_policies(
    policy: DataFrame, sellers: DataFrame, plan: DataFrame, product: DataFrame, stored: DataFrame, lines: Sequence[str], since: date
) -> DataFrame:
    """Account rows of policies that started since the cut and are not in the account table yet.

    Type 1 new, 2 renewed; booked on the later of start and creation; fees are premium times rate.
    """
    fresh = policy.where((F.length("policy_code") > 0) & (F.col("start_date") >= F.lit(since)))
    rows = _accounts(fresh, sellers, plan, product, lines)
    columns = {
        **_common(),
        **_fees(F.col("first_premium")),
        "preserve_id": F.lit(None).cast("string"),
        "business_type": F.when(F.col("predecessor_id").isNull(), "1").otherwise("2"),
        "accounting_day": F.greatest("start_date", "created"),
        "effective_day": F.col("start_date"),
        "expire_day": F.col("end_date"),
        "payment": F.lit("1"),
    }
    booked = rows.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in ACCOUNT_COLUMNS]).distinct()
    return booked.join(stored.select("policy_code").distinct(), "policy_code", "left_anti")


def accounting_day() -> Column:
    """Booking day of an endorsement.

    Of a cancelled policy with both dates, an inverted pair books on the latest of policy start, start and creation; with
    a date missing, on the latest of all four. Anything else books on its start, else its end, but never before creation.
    """
    start, end, created = F.col("preserve_start"), F.col("preserve_end"), F.col("created")
    plain = F.when(start.isNull(), F.when(end >= created, end).otherwise(created)).otherwise(
        F.when(start >= created, start).otherwise(created)
    )
    cancelled, both = F.col("policy_status") == -1, start.isNotNull() & end.isNotNull()
    return (
        F.when(cancelled & both, F.when(start > end, F.greatest("policy_start", start, created)).otherwise(plain))
        .when(cancelled, F.greatest("policy_start", start, end, created))
        .otherwise(plain)
    )


def settlement_endorsements(
    endorsement: DataFrame, policy: DataFrame, sellers: DataFrame, plan: DataFrame, product: DataFrame, stored: DataFrame,
    lines: Sequence[str], since: date,
) -> DataFrame:
    """Account rows of endorsements in effect since the cut that are not in the account table yet."""
    master = policy.select("policy_id", "policy_code", "product_code", "holder_name", "insurer", "policy_status", F.col("start_date").alias("policy_start"))
    recent = endorsement.where(
        (F.col("preserve_status") == 1) & (F.coalesce("preserve_start", "preserve_end", "created") >= F.lit(since))
    )
    rows = _accounts(recent.join(master, "policy_id"), sellers, plan, product, lines)
    columns = {
        **_common(),
        **_fees(zero_money(F.col("add_premium")) + zero_money(F.col("del_premium"))),
        "business_type": code_of(F.col("preserve_type"), ENDORSEMENT_CODE),
        "accounting_day": accounting_day(),
        "effective_day": F.coalesce("preserve_start", "preserve_end", "effective_date"),
        "expire_day": F.col("preserve_end"),
        "payment": code_of(F.col("pay_status"), PAYMENT_CODE),
    }
    booked = rows.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in ACCOUNT_COLUMNS]).distinct()
    known = stored.where(F.col("preserve_id").isNotNull()).select("policy_code", "preserve_id").distinct()
    return booked.join(known, ["policy_code", "preserve_id"], "left_anti")


def settlement_backfill(accounts: DataFrame, sellers: DataFrame, status: DataFrame) -> DataFrame:
    """Fill empty channel, owner, source and operator from the sales table and refresh the policy status."""
    filled = {
        "channel_name": "s_channel", "business_owner": "s_owner", "business_source": "s_source", "operator_name": "s_operator",
    }
    s = sellers.select(
        "ent_name", F.col("channel_name").alias("s_channel"), F.col("salesman").alias("s_owner"),
        F.col("business_source").alias("s_source"), F.col("biz_operator").alias("s_operator"),
    )
    now = status.select("policy_code", F.col("policy_status").cast("string").alias("current_status"))
    return (
        accounts.join(s, F.col("holder_name") == F.col("ent_name"), "left")
        .withColumns({c: F.coalesce(F.when(F.length(c) > 0, F.col(c)), F.col(v)) for c, v in filled.items()})
        .join(now, "policy_code", "left")
        .withColumn("policy_status", F.coalesce("current_status", "policy_status"))
        .drop("ent_name", "current_status", *filled.values())
    )


def all_channels_ledger(
    accounts: DataFrame, interface: DataFrame, agency: DataFrame, policy: DataFrame, endorsement: DataFrame, area: DataFrame,
    milestones: DataFrame,
) -> DataFrame:
    """Accounts, interface products and agency rows in one ledger.

    People come from the endorsement where there is one, else from the policy. Employer-line channels carry the dates of
    their first, sixth and twelfth month.
    """
    places = area.select(F.col("code").alias("city_code"), "province", F.col("city").alias("city"))
    master = policy.select("policy_code", "person_count", F.concat(F.substring("region_code", 1, 4), F.lit("00")).alias("city_code")).join(
        places, "city_code", "left"
    )
    moved = endorsement.where("preserve_status = 1").select(
        "preserve_id",
        (F.coalesce("add_person_count", F.lit(0)) - F.coalesce("del_person_count", F.lit(0))).alias("moved"),
    )
    own = (
        accounts.withColumn("holder_name", no_line_breaks(F.col("holder_name")))
        .join(master, "policy_code", "left")
        .join(moved, "preserve_id", "left")
        .withColumn("people", F.coalesce("moved", "person_count"))
        .withColumn("source", F.lit("acount"))
    )
    keep = ["policy_code", "product_code", "channel_name", "accounting_day", "holder_name", "premium_total", "economy_fee", "brokerage_fee",
            "sale_name", "business_line", "people", "province", "city", "source"]
    whole = (
        own.withColumn("sale_name", F.col("business_owner")).select(*keep)
        .unionByName(interface.withColumn("source", F.lit("inter")).select(*[c for c in keep if c in [*interface.columns, "source"]]), allowMissingColumns=True)
        .unionByName(agency.withColumn("source", F.lit("plat")).select(*[c for c in keep if c in [*agency.columns, "source"]]), allowMissingColumns=True)
    )
    steps = milestones.select("channel_name", F.lit(EMPLOYER).alias("business_line"), "first_start", "three_month", "six_month", "twelve_month")
    return whole.join(steps, ["channel_name", "business_line"], "left")


def channel_milestones(policy: DataFrame) -> DataFrame:
    """First start of a channel, and the days three, six and twelve months on."""
    first = policy.groupBy("channel_name").agg(F.min("start_date").alias("first_start"))
    return first.withColumns(
        {n: F.add_months("first_start", m) for n, m in (("three_month", 3), ("six_month", 6), ("twelve_month", 12))}
    )


def sales_performance(ledger: DataFrame, sales: DataFrame, team: DataFrame, since: date) -> DataFrame:
    """Premium by channel, day, line and salesman, with department, team and group.

    On the employer line the salesman of a new customer is the seller, else the operator; nobody means the company. A group
    without a name falls back to the salesman. The seller lookup applies to the employer line only, inside the join.
    """
    sellers = sales.select("ent_name", "consumer_new_old", "biz_operator")
    employer = F.col("business_line") == EMPLOYER
    joined = ledger.where((F.col("source") != "inter") & (F.col("accounting_day") >= F.lit(since))).join(
        sellers, employer & (F.col("holder_name") == F.col("ent_name")), "left"
    )
    salesman = F.when(~employer | (F.col("consumer_new_old") == "new"), F.col("sale_name")).otherwise(F.col("biz_operator"))
    sums = joined.groupBy(
        F.coalesce("channel_name", "holder_name").alias("channel_name"), "accounting_day", F.col("business_line").alias("category"), salesman.alias("seller")
    ).agg(F.sum("premium_total").alias("premium"))
    teams = team.select(F.col("sale_name").alias("salesman"), "team_name", "department", "group_name")
    return (
        sums.withColumn("salesman", F.coalesce("seller", F.lit(COMPANY)))
        .join(teams, "salesman", "left")
        .select(
            F.coalesce("channel_name", F.lit("未知")).alias("channel_name"), "accounting_day", "premium", "category", "salesman",
            "department", "team_name",
            F.when(F.length("group_name") == 0, F.col("seller")).otherwise(F.col("group_name")).alias("sales_group"),
        )
    )


def masked_sample(performance: DataFrame, seed: int) -> DataFrame:
    """The same report for demos: channel names masked, premium scaled by a factor in [0, 1).

    The factor comes from the md5 of the row and the seed, so a rerun or a recomputed partition gives the same sample.
    """
    row = F.concat_ws("|", F.lit(str(seed)), "channel_name", F.col("accounting_day").cast("string"), "category", "salesman")
    hashed = F.conv(F.substring(F.md5(row), 1, 7), 16, 10).cast("bigint") % 1000000
    factor = hashed.cast("decimal(6,0)") * F.lit(Decimal("0.000001"))  # exact, so that the product is rounded once
    return performance.withColumns(
        {"channel_name": mask_name(F.col("channel_name")), "premium": (F.col("premium").cast("decimal(24,4)") * factor).cast("decimal(24,4)")}
    )


def sales_process(movements: DataFrame, visits: DataFrame, team: DataFrame) -> DataFrame:
    """Policies and endorsements underwritten per salesman and day beside the visits reported for it.

    Either side may be missing for a day. ``movements`` are the ledger rows of new customers with salesman and team.
    """
    counts = ["add_premium", "del_premium", "add_person_count", "del_person_count", "sum_person", "sum_premium"]
    done = movements.groupBy("salesman", "team_name", "group_name", "day").agg(
        F.count_if(F.col("preserve_id").isNull()).alias("policies"),
        F.count_if(F.col("preserve_id").isNotNull()).alias("endorsements"),
        *[F.sum(c).alias(c) for c in counts],
    )
    reports = ["contacts", "visitors", "intended"]
    seen = visits.groupBy("salesman", "team_name", "day").agg(*[F.sum(c).alias(c) for c in reports])
    groups = team.select(F.col("sale_name").alias("salesman"), F.col("group_name").alias("t_group")).distinct()
    both = done.alias("d").join(seen.alias("v"), (F.col("d.salesman") == F.col("v.salesman")) & (F.col("d.day") == F.col("v.day")), "full")
    return (
        both.select(
            F.coalesce("d.salesman", "v.salesman").alias("salesman"),
            F.coalesce("d.team_name", "v.team_name").alias("team_name"),
            F.coalesce("d.day", "v.day").alias("day"),
            "group_name",
            *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ["policies", "endorsements", *counts, *reports]],
        )
        .join(groups, "salesman", "left")
        .withColumn("group_name", F.coalesce("group_name", "t_group"))
        .drop("t_group")
    )
