"""Master data: two source systems conformed into one set of tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlake.functions import certificate as cert
from coverlake.functions.text import chinese_only, clean, md5_trimmed, no_line_breaks
from coverlake.operators.claims import claims_in_cover
from coverlake.operators.premium import DIRECT_CHANNEL

MONEY = "decimal(14,4)"
LIVE_STATUSES = [0, 1, -1]

# Cities that are their own province, and the line of business with customers of its own.
MUNICIPALITIES = ["北京市", "天津市", "重庆市", "上海市"]
SPORT_LINE = "体育"
# Coded plan attributes.
DISABILITY_SCALE = {"K1": "0.01", "K2": "0.05", "K3": "0.1"}
HEADCOUNT_BAND = {"K1": "5-100", "K2": "101-300", "K3": "301-500", "K4": ":501人及以上"}
INSURED_NUMBER_BAND = {"1": "1-50", "2": "51-500", "3": "501以上"}
YES_NO = {"1": "Y", "0": "N"}
PROFESSION_CODE = {"K2": "1-3类", "K3": "1-4类", "K4": "5类"}


def coded(c: Column, codes: dict[str, str], keep_unknown: bool = True) -> Column:
    """Translate codes; an unknown code stays as it is, or becomes null."""
    out = None
    for code, text in codes.items():
        out = F.when(c == code, text) if out is None else out.when(c == code, text)
    return out.otherwise(c) if keep_unknown else out


def region_of(province: Column, city: Column, county: Column) -> Column:
    """Region code from three six-digit codes: two digits of each; null unless all three are complete."""
    whole = (F.length(province) == 6) & (F.length(city) == 6) & (F.length(county) == 6)
    return F.when(whole, F.concat(F.substring(province, 1, 2), F.substring(city, 3, 2), F.substring(county, 5, 2)))


def policy_state(status: Column, end: Column, as_of: Column) -> Column:
    """1 in force, 0 ended, -1 cancelled, 99 anything else."""
    return (
        F.when((status == 1) & (end > as_of), 1)
        .when((status == 4) | ((status == 1) & (end < as_of)), 0)
        .when(status == -1, -1)
        .otherwise(99)
    )


def policy_conform(one: DataFrame, two: DataFrame, as_of: date) -> DataFrame:
    """Policies of both systems in one layout.

    System two knows its predecessor by its own number, which is resolved to the insurer's policy code; its holder is the
    company or person on file, else the name on the policy.
    """
    codes = two.where(F.col("policy_no").isNotNull()).select(
        F.col("policy_no").alias("continued_policy_no"), F.col("policy_code").alias("continued_code")
    )
    second = two.join(codes, "continued_policy_no", "left").select(
        "policy_id",
        "policy_code",
        F.when(F.col("continued_policy_no").isNotNull(), F.col("continued_code")).alias("preserve_policy_no"),
        policy_state(F.col("status"), F.col("end_date"), F.lit(as_of)).alias("policy_status"),
        F.coalesce("holder_on_file", "holder_name").alias("holder_name"),
        region_of(F.col("province_code"), F.col("city_code"), F.col("county_code")).alias("belongs_regional"),
        F.coalesce("paid_premium", "first_premium", "sum_premium").cast(MONEY).alias("first_premium"),
        "start_date",
        "end_date",
        F.lit("2.0").alias("source_system"),
    )
    first = one.select(
        "policy_id",
        "policy_code",
        clean(F.col("preserve_policy_no")).alias("preserve_policy_no"),
        policy_state(F.col("status"), F.col("end_date"), F.lit(as_of)).alias("policy_status"),
        F.coalesce("holder_on_file", "holder_name").alias("holder_name"),
        F.when(F.length("belongs_regional") == 6, F.col("belongs_regional")).alias("belongs_regional"),
        F.coalesce("paid_premium", "first_premium", "sum_premium").cast(MONEY).alias("first_premium"),
        "start_date",
        "end_date",
        F.lit("1.0").alias("source_system"),
    )
    return first.unionByName(second)


def insured_conform(one: DataFrame, two: DataFrame, excluded_users: Sequence[str] = ()) -> DataFrame:
    """Insured people of both systems; names and work types keep their Chinese characters only."""
    kept = one.where(F.col("user_id").isNull() | ~F.col("user_id").isin(list(excluded_users))) if excluded_users else one
    # the cleaned number is a column of its own: the age reads it many times over
    whole = kept.drop("user_id").unionByName(two.drop("user_id")).withColumn("cert_no", clean(no_line_breaks(F.col("cert_no"))))
    known = F.col("cert_type") == "1"
    return whole.select(
        "insured_id",
        "policy_id",
        clean(chinese_only(no_line_breaks(F.col("name")))).alias("insured_name"),
        clean(chinese_only(no_line_breaks(F.col("work_type")))).alias("work_type"),
        F.when(known, 1).otherwise(-1).alias("cert_type"),
        "cert_no",
        clean(F.col("mobile")).alias("mobile"),
        F.when(F.col("sex") == 2, 0).when(F.col("sex") == 1, 1).alias("gender"),
        F.when(known & F.col("start_date").isNotNull(), cert.age_at(F.col("cert_no"), F.col("start_date"))).alias("age"),
        "start_date",
        "end_date",
    )


def dependant_conform(rows: DataFrame) -> DataFrame:
    """People who accompany an insured person."""
    return rows.select(
        "master_id",
        clean(no_line_breaks(F.col("name"))).alias("slave_name"),
        F.when(F.col("cert_type") == "1", 1).otherwise(-1).alias("slave_cert_type"),
        clean(no_line_breaks(F.col("cert_no"))).alias("slave_cert_no"),
    )


def holder_conform(one: DataFrame, two: DataFrame) -> DataFrame:
    """Person holders of both systems, distinct."""
    whole = one.unionByName(two).where(F.length("name") > 0)
    return whole.select(
        "policy_id",
        clean(F.col("name")).alias("holder_name"),
        F.when(F.col("cert_type") == 1, 1).otherwise(-1).alias("holder_cert_type"),
        clean(F.col("cert_no")).alias("holder_cert_no"),
        F.when(F.col("sex") == 2, 0).otherwise(1).alias("gender"),
        clean(F.col("mobile")).alias("mobile"),
    ).distinct()


def enterprise_conform(one: DataFrame, two: DataFrame) -> DataFrame:
    """One row per enterprise name: attributes of the latest record, system two before system one. Id is md5(name)."""
    attributes = [c for c in one.columns if c not in ("ent_name", "updated", "record_id")]
    whole = one.withColumn("system", F.lit(1)).unionByName(two.withColumn("system", F.lit(2)))
    latest = F.max_by(F.struct(*attributes, "updated", "system"), F.struct("system", "updated", "record_id"))
    return (
        whole.where(F.col("ent_name").isNotNull())
        .groupBy(F.trim("ent_name").alias("ent_name"))
        .agg(latest.alias("row"))
        .select(F.md5("ent_name").alias("ent_id"), "ent_name", "row.*")
    )


def enterprise_contacts(one: DataFrame, two: DataFrame) -> DataFrame:
    """Distinct contact people of enterprises in both systems."""
    whole = one.unionByName(two).where(F.length("ent_name") > 0)
    return whole.select(
        md5_trimmed(F.col("ent_name")).alias("ent_id"), clean(F.col("contact")).alias("contact"), clean(F.col("mobile")).alias("mobile")
    ).distinct()


def plan_conform(plan: DataFrame, history: DataFrame, rates: DataFrame, fixed_rates: dict[str, str]) -> DataFrame:
    """Price plans: a history row replaces the current plan; missing rates come from the product, some are fixed.

    ``commission_rate`` is technical plus broker rate, an absent one counting as nothing, both absent giving null.
    """
    parts = ["sku_coverage", "sku_ratio", "sku_price", "sku_charge_type"]
    old = history.select("policy_id", F.lit(True).alias("replaced"), *[F.col(c).alias(f"h_{c}") for c in parts])
    fixed = None
    for product, rate in fixed_rates.items():
        rate_of = F.lit(rate).cast(MONEY)
        fixed = F.when(F.col("product_code") == product, rate_of) if fixed is None else fixed.when(F.col("product_code") == product, rate_of)
    broker = F.coalesce(fixed, F.col("broker_rate")) if fixed is not None else F.col("broker_rate")
    merged = (
        plan.distinct()
        .join(old, "policy_id", "left")
        .join(rates.select("product_code", F.col("tech_rate").alias("p_tech"), F.col("broker_rate").alias("p_broker")), "product_code", "left")
        .select(
            "policy_id",
            "product_code",
            *[F.when(F.col("replaced"), F.col(f"h_{c}")).otherwise(F.col(c)).alias(c) for c in parts],
            F.coalesce("tech_rate", "p_tech").cast(MONEY).alias("tech_rate"),
            F.coalesce(broker, F.col("p_broker")).cast(MONEY).alias("broker_rate"),
        )
    )
    nothing = F.lit(0).cast(MONEY)
    total = F.coalesce("tech_rate", nothing) + F.coalesce("broker_rate", nothing)
    known = F.col("tech_rate").isNotNull() | F.col("broker_rate").isNotNull()
    return merged.withColumn("commission_rate", F.when(known, total).cast(MONEY))


def endorsement_conform(endorsement: DataFrame, people: DataFrame) -> DataFrame:
    """Endorsements with the latest join and earliest leave date of the people on them.

    Effective: a pure removal the day after the leave date; a cancellation its creation day; anything else the join date.
    Type 1 and 2 stay, 5 becomes 3 (cancelled), the rest -1.
    """
    join, leave = F.coalesce("join_date", "leave_date"), F.coalesce("leave_date", "join_date")
    dates = people.groupBy("preserve_id").agg(F.max(join).alias("join_date"), F.min(leave).alias("leave_date"))
    removal = (F.col("add_person_count") == 0) & (F.col("del_person_count") > 0)
    start = F.when(~removal, F.col("join_date"))
    end = F.when(removal, F.date_add("leave_date", 1)).otherwise(F.col("leave_date"))
    kind = F.col("source_type")
    return endorsement.join(dates, "preserve_id", "left").select(
        "preserve_id",
        "policy_id",
        F.when(kind.isin(1, 2), kind).when(kind == 5, 3).otherwise(-1).alias("preserve_type"),
        start.alias("preserve_start"),
        end.alias("preserve_end"),
        F.when(removal, F.date_add("leave_date", 1)).when(kind == 5, F.col("created")).otherwise(F.col("join_date")).alias("effective_date"),
        "add_person_count",
        "del_person_count",
    )


def endorsement_people(people: DataFrame, endorsement: DataFrame, insured: DataFrame) -> DataFrame:
    """People on an endorsement: 1 joins (only a join date), 2 leaves, with the policy and the person's work type."""
    kind = F.when(F.col("leave_date").isNull(), 1).otherwise(2)
    return (
        people.join(endorsement.select("preserve_id", "policy_id"), "preserve_id")
        .join(insured.select("policy_id", "insured_id", "cert_no"), ["policy_id", "insured_id"], "left")
        .select("preserve_id", "policy_id", "insured_id", "cert_no", "join_date", "leave_date", kind.alias("person_type"))
    )


def first_known(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows of one key merged into one: per column the first value that is known, in the stated order."""
    rest = [c for c in df.columns if c not in (key, *order)]
    position = F.struct(*order)

    def first(c: str) -> Column:
        known = F.col(c).isNotNull()
        return F.min_by(F.when(known, F.col(c)), F.when(known, position)).alias(c)

    return df.groupBy(key).agg(*[first(c) for c in rest])


def work_grade_conform(catalogues: Sequence[DataFrame]) -> DataFrame:
    """Plan catalogues merged by policy, earlier catalogues first, with coded attributes spelled out."""
    whole = None
    for rank, catalogue in enumerate(catalogues):
        ranked = catalogue.withColumn("rank", F.lit(rank))
        whole = ranked if whole is None else whole.unionByName(ranked)
    merged = first_known(whole, "policy_id", ["rank", "row_id"])
    return merged.select(
        "policy_id",
        F.coalesce(coded(F.col("profession_code"), PROFESSION_CODE, keep_unknown=False), F.col("profession_type")).alias("profession_type"),
        coded(F.col("disability_scale"), DISABILITY_SCALE).alias("disability_scale"),
        coded(F.col("min_num"), HEADCOUNT_BAND).alias("headcount_band"),
        coded(F.col("insured_number"), INSURED_NUMBER_BAND).alias("insured_number_band"),
        coded(F.col("join_social"), YES_NO, keep_unknown=False).alias("join_social"),
        coded(F.col("is_commission"), YES_NO).alias("is_commission"),
    )


def city_of() -> Column:
    """A municipality's city is its province."""
    return F.when(F.col("province").isin(MUNICIPALITIES), F.col("province")).otherwise(F.col("city"))


def area_lookup(area: DataFrame, prefix: str) -> DataFrame:
    """Areas by six-digit city code: ``<prefix>_code``, ``<prefix>_province``, ``<prefix>_city``."""
    return area.select(
        F.col("code").alias(f"{prefix}_code"), F.col("province").alias(f"{prefix}_province"), city_of().alias(f"{prefix}_city")
    )


def city_code(region: Column) -> Column:
    return F.concat(F.substring(region, 1, 4), F.lit("00"))


def latest_region(policy: DataFrame, key: str = "holder_name") -> DataFrame:
    """Region of each holder's latest policy that names one."""
    known = policy.where(F.col("region_code").isNotNull())
    return known.groupBy(key).agg(F.max_by("region_code", F.struct("start_date", "policy_id")).alias("latest_region"))


def named_sales(sales: DataFrame, team: DataFrame) -> DataFrame:
    """Sales assignment with the salesman's team; a direct customer is its own channel."""
    channel = F.when(F.col("channel_name") == DIRECT_CHANNEL, F.col("ent_name")).otherwise(F.col("channel_name"))
    teams = team.select(F.col("sale_name").alias("salesman"), "team_name", "department", "group_name")
    return sales.withColumn("channel_name", channel).join(teams, "salesman", "left")


def policy_master_wide(
    policy: DataFrame, area: DataFrame, sales: DataFrame, team: DataFrame, product: DataFrame, plan: DataFrame,
    work_grade: DataFrame, line: str,
) -> DataFrame:
    """Policies of one product line with insurer, region, enterprise, sales team, product, plan and grade."""
    return (
        policy.where(F.col("policy_status").isin(LIVE_STATUSES))
        .select("policy_id", "policy_code", "policy_status", "start_date", "end_date", "insurer", "holder_name", "first_premium", "person_count", "product_code")
        .join(product.where(F.col("one_level") == line), "product_code")
        .join(latest_region(policy), "holder_name", "left")
        .withColumn("region_city", city_code(F.col("latest_region")))
        .join(area_lookup(area, "holder"), F.col("region_city") == F.col("holder_code"), "left")
        .join(named_sales(sales, team), F.col("holder_name") == F.col("ent_name"), "left")
        .join(plan.select("policy_id", "sku_coverage", "sku_ratio", "sku_price", "sku_charge_type", "tech_rate", "broker_rate"), "policy_id", "left")
        .join(work_grade.select("policy_id", "profession_type"), "policy_id", "left")
        .withColumn("insurer_short", F.split_part(F.col("insurer"), F.lit("-"), F.lit(2)))
        .drop("holder_code", "ent_name")
    )


def policy_person_wide(master: DataFrame, insured: DataFrame, claim: DataFrame) -> DataFrame:
    """The policy master by insured person: cover cut to the policy period, claims of the cover attached."""
    s, e = F.coalesce("i.start_date", "i.end_date"), F.coalesce("i.end_date", "i.start_date")
    claims = claims_in_cover(insured, claim).drop("claim_cases")
    people = insured.alias("i").join(master.alias("m"), F.col("i.policy_id") == F.col("m.policy_id"))
    wide = people.select(
        "i.insured_id", "i.policy_id", "i.cert_no", "i.start_date",
        F.greatest(s, F.col("m.start_date")).alias("cover_start"),
        F.least(e, F.col("m.end_date")).alias("cover_end"),
        *[f"m.{c}" for c in ("holder_name", "product_code", "channel_name", "salesman", "team_name", "holder_province", "profession_type", "sku_price")],
    )
    return wide.join(claims, ["policy_id", "cert_no", "start_date"], "left")


def non_employer_master(
    policy: DataFrame, product: DataFrame, sport_customers: DataFrame, team: DataFrame, plan: DataFrame, excluded_lines: Sequence[str],
    line_salesman: dict[str, str],
) -> DataFrame:
    """Policies of the other lines. The salesman is the one on the policy, else the one ``line_salesman`` names for the line.

    The salesman is computed before the team is joined, so that join stays an equi-join.
    """
    rule = F.when(F.col("business_line") == SPORT_LINE, F.col("sport_sales"))
    for line, name in line_salesman.items():
        rule = rule.when(F.col("business_line") == line, name)
    teams = team.select(F.col("sale_name").alias("sales_name"), "team_name", "department", "group_name")
    sports = sport_customers.where(F.col("type") == 1).select(F.col("name").alias("channel"), F.col("sales_name").alias("sport_sales"))
    return (
        policy.where(F.col("policy_status").isin(LIVE_STATUSES))
        .join(product.where(~F.col("business_line").isin(list(excluded_lines))), "product_code")
        .join(sports, "channel", "left")
        .withColumn("sales_name", F.coalesce(F.col("policy_sales"), rule))
        .join(teams, "sales_name", "left")
        .join(plan.select("policy_id", "tech_rate", "broker_rate"), "policy_id", "left")
        .withColumn("channel_id", F.md5("channel"))
        .drop("sport_sales", "policy_sales")
    )


def holder_summary(policy: DataFrame, area: DataFrame, sales: DataFrame, team: DataFrame, product: DataFrame, lines: Sequence[str]) -> DataFrame:
    """Per holder, its latest region and insurer: the holder's latest start with that insurer's list, and its sales team."""
    chosen = policy.where(F.col("policy_status").isin(LIVE_STATUSES)).join(
        product.where(F.col("two_level").isin(list(lines))).select("product_code"), "product_code", "left_semi"
    )
    newest = chosen.groupBy("holder_name").agg(
        F.max_by("region_code", F.when(F.col("region_code").isNotNull(), F.struct("start_date", "policy_id"))).alias("region_code"),
    )
    first = chosen.groupBy("holder_name", "insurer").agg(F.min("start_date").alias("first_start"))
    return (
        first.join(newest, "holder_name")
        .withColumn("region_city", city_code(F.col("region_code")))
        .join(area_lookup(area, "holder"), F.col("region_city") == F.col("holder_code"), "left")
        .join(named_sales(sales, team), F.col("holder_name") == F.col("ent_name"), "left")
        .drop("holder_code", "region_city")
    )


def salesman_assignment(proposal: DataFrame, stored: DataFrame, operators: DataFrame) -> DataFrame:
    """Enterprises seen in proposals but not stored yet, with channel, salesman and operator.

    A direct customer is its own channel. A channel already known keeps its stored salesman and operator; otherwise the
    operator follows the province. Ids are md5 of the names.
    """
    direct = F.col("channel_user_type") == 2
    named = proposal.select(
        F.md5("holder_name").alias("ent_id"),
        F.col("holder_name").alias("ent_name"),
        F.when(direct, F.md5("holder_name")).otherwise(F.md5("channel_name")).alias("channel_id"),
        F.when(direct, F.lit(DIRECT_CHANNEL)).otherwise(F.col("channel_name")).alias("channel_name"),
        "salesman",
        "province",
    ).distinct()
    channel = F.when(F.col("channel_name") == DIRECT_CHANNEL, F.col("ent_name")).otherwise(F.col("channel_name"))
    known = (
        stored.withColumn("key", channel)
        .groupBy("key")
        .agg(F.min_by(F.struct("salesman", "biz_operator"), F.struct(F.col("salesman").isNull(), "salesman", "biz_operator")).alias("k"))
        .select("key", F.lit(True).alias("known"), "k.*")
        .withColumnsRenamed({"salesman": "stored_salesman", "biz_operator": "stored_operator"})
    )
    return (
        named.join(stored.select("ent_id"), "ent_id", "left_anti")
        .join(operators, "province", "left")
        .withColumn("key", channel)
        .join(known, "key", "left")
        .select(
            "ent_id", "ent_name", "channel_id", "channel_name",
            F.when(F.col("known"), F.col("stored_salesman")).otherwise(F.col("salesman")).alias("salesman"),
            F.when(F.col("known"), F.col("stored_operator")).otherwise(F.col("biz_operator")).alias("biz_operator"),
        )
    )


def paid_instalments(instalment: DataFrame, policy: DataFrame, person: DataFrame, number: str) -> DataFrame:
    """Paid instalments with policy and insured person; the id is the chosen number and the payment's timestamp."""
    paid = instalment.where(F.col("status") == 2)
    return (
        paid.join(policy, "policy_no", "left")
        .join(person, "proposal_no", "left")
        .withColumn("preserve_id", F.concat(F.col(number), F.lit("_"), F.date_format("paid_at", "yyyyMMddHHmmss")))
    )


def proposal_person_risk(proposal: DataFrame, person: DataFrame, work_grade: DataFrame, work_match: DataFrame, work_risk: DataFrame) -> DataFrame:
    """People on proposals with the grade of the plan and the risk class of their work."""
    risk = work_risk.select(
        F.col("standard_work_name").alias("work_name_check"), F.col("standard_work_risk").alias("work_risk"), F.substring("gs_work_risk", 1, 1).alias("gs_first")
    )
    return (
        proposal.join(person, "policy_id")
        .join(work_grade.select("policy_id", "profession_type"), "policy_id", "left")
        .join(work_match, F.col("work_type") == F.col("primitive_work"), "left")
        .join(risk, "work_name_check", "left")
    )


def located_policies(policy: DataFrame, product: DataFrame, line: str) -> DataFrame:
    """Live policies of the products of one line, the policies of :func:`insured_location`."""
    of_line = product.where(F.col("one_level") == line).select("product_code")
    return policy.where(F.col("policy_status").isin(LIVE_STATUSES)).join(of_line, "product_code", "left_semi")


def insured_location(policy: DataFrame, insured: DataFrame, area: DataFrame, product: DataFrame, sales: DataFrame, line: str) -> DataFrame:
    """Where the holder, the insured person and the job are.

    The holder's region is the longest code on any of its policies; the job is where the employer named on the cover took
    out its first policy, else where the holder is.
    """
    longest = policy.where(F.col("region_code").isNotNull()).groupBy("holder_name").agg(
        F.max_by("region_code", F.struct(F.length("region_code"), F.col("policy_id"))).alias("longest")
    )
    holder = longest.withColumn("c", city_code(F.col("longest"))).join(area_lookup(area, "holder"), F.col("c") == F.col("holder_code"), "left")
    first = policy.groupBy("holder_name").agg(F.min_by(F.struct("region_code"), F.struct("start_date", "policy_id")).alias("f"))
    job = (
        first.withColumn("c", city_code(F.col("f.region_code")))
        .join(area_lookup(area, "job"), F.col("c") == F.col("job_code"), "left")
        .select(F.col("holder_name").alias("job_company"), "job_province", "job_city")
    )
    channel = F.when(F.col("channel_name") == DIRECT_CHANNEL, F.col("ent_name")).otherwise(F.col("channel_name"))
    sellers = sales.select(F.col("ent_name").alias("holder_name"), channel.alias("channel_name"))
    master = (
        located_policies(policy, product, line)
        .select("policy_id", "holder_name")
        .join(holder.select("holder_name", "holder_province", "holder_city"), "holder_name", "left")
        .join(sellers, "holder_name", "left")
    )
    people = insured.withColumn("home", cert.home_code(F.col("cert_no"))).join(
        area_lookup(area, "insured"), F.col("home") == F.col("insured_code"), "left"
    )
    return (
        master.join(people.select("insured_id", "policy_id", "cert_no", "job_company", "insured_province", "insured_city"), "policy_id", "left")
        .withColumn("job_company", F.coalesce("job_company", "holder_name"))
        .join(job, "job_company", "left")
        .withColumns(
            {"job_province": F.coalesce("job_province", "holder_province"), "job_city": F.coalesce("job_city", "holder_city")}
        )
    )


def sports_policies(policy: DataFrame, product: DataFrame, customers: DataFrame, default_sales: str) -> DataFrame:
    """Sports policies with the customer dimension and its defaults; a date is the later of itself and the creation."""
    dims = customers.where(F.col("type") == 1).select(
        F.col("name").alias("channel"),
        F.coalesce("customer_type", F.lit("日常营销")).alias("customer_type"),
        F.coalesce("sales_name", F.lit(default_sales)).alias("sales_name"),
        F.coalesce("source", F.lit("线上业务")).alias("source"),
    )
    kind = F.when(F.col("policy_type") == "1", "个单").otherwise("团单")
    return (
        policy.where(F.col("policy_status").isin(LIVE_STATUSES) & F.col("insurer").isNotNull())
        .where(F.col("created").isNotNull() | F.col("start_date").isNotNull())
        .join(product.where(F.col("business_line") == SPORT_LINE).select("product_code", "product_name"), "product_code")
        .join(dims, "channel", "left")
        .select(
            "policy_id", "policy_code", "holder_name", "channel", "product_name", kind.alias("policy_type"),
            F.greatest("start_date", "created").alias("start_date"), "end_date",
            F.when(F.col("person_count") == 0, 1).otherwise(F.col("person_count")).alias("people"),
            F.col("first_premium").cast(MONEY).alias("premium"), "customer_type", "sales_name", "source",
        )
        .distinct()
    )
