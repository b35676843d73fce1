"""Person profiles.

Lists and histograms stay in long form, one row per element: a person's list is never collected into one cell unless the
set of possible elements is small and fixed. "First" and "last" are min_by and max_by with a unique tiebreak.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coverlake.functions import certificate as cert
from coverlake.functions.dates import day_gap, is_school_age, ride_bucket, weekday_monday_first
from coverlake.functions.text import drop_empty

MONEY = "decimal(14,4)"
LIVE_STATUSES = [0, 1, -1]
NEW_PERIOD = 90

# Sports looked for in a product name, first match wins, and products bought for children.
SPORTS = ["骑行", "足球", "游泳", "篮球", "滑雪", "滑冰", "铁人三项", "马拉松", "羽毛球", "登山"]
CHILD_PRODUCTS = ["学幼险", "信美相互爱我宝贝少儿白血病保险"]
SPORT_LINE = "体育"
TRAVEL_PRODUCTS = ["12000001", "12000002", "12000003", "P00001647", "P00001678", "F201700001"]
REJECTED, WITHDRAWN = "拒赔", "撤案"
BIKE_BRANDS = [
    "星驾单车", "七彩单车", "闪骑电单车", "DDbike", "酷骑单车", "小鹿单车", "骑迹单车", "OFO", "便利蜂单车", "飞鸽出行", "西游单车", "景智单车",
]


@dataclass(frozen=True)
class InterestProducts:
    """Product descriptions that stand for an interest."""

    cosmetics: str = "新氧医美"
    wedding: str = "婚礼纪-婚礼保"
    ride_hailing: str = "曹操意外险"
    landlord: str = "侃家"
    frequent: str = "青芒果方案1"
    part_time: Sequence[str] = ("斗米兼职", "万能小哥", "弧聚网络", "找活儿兼职", "第二职场", "蒲公英", "独立日")


def full_certs(df: DataFrame, column: str = "cert_no") -> DataFrame:
    return df.where(F.length(column) == 18)


def people_of(*sources: DataFrame) -> DataFrame:
    """Insured, dependants and holders as one list of (cert_no, name), one row per certificate, none with a star."""
    whole = sources[0]
    for s in sources[1:]:
        whole = whole.unionByName(s)
    listed = full_certs(whole).where(cert.has_no_star(F.col("cert_no")))
    return listed.groupBy("cert_no").agg(F.min(drop_empty(F.col("name"))).alias("name"))


def person_base(people: DataFrame, area: DataFrame, as_of: date) -> DataFrame:
    """What the certificate says: gender, birthday, age and its bands, home, star sign."""
    c, age = F.col("cert_no"), F.col("age")
    homes = area.select(F.col("code").alias("home_code"), F.col("province").alias("home_province"), F.col("city").alias("home_city"))
    return (
        people.withColumn("age", cert.age_at(c, F.lit(as_of)))
        .withColumns(
            {
                "gender": cert.profile_gender(c),
                "birthday": F.substring(c, 7, 8),
                "decade": cert.decade(c),
                "age_band": cert.age_band(age),
                "retired": cert.retired(age),
                "home_code": cert.home_code(c),
                "star_sign": cert.star_sign(F.substring(c, 11, 2).try_cast("int"), F.substring(c, 13, 2).try_cast("int")),
            }
        )
        .join(homes, "home_code", "left")
    )


def person_phones(people: DataFrame, phone: DataFrame) -> DataFrame:
    """Distinct phones per person with province, city and operator; phones known only in part are dropped."""
    known = (
        full_certs(people).where(F.col("mobile").isNotNull()).select("cert_no", "mobile").distinct().join(phone, "mobile", "left")
    )
    facts = [F.col("phone_province"), F.col("phone_city"), F.col("operator")]
    filled = sum((f.isNotNull().cast("int") for f in facts), F.lit(0))
    return known.where(filled.isin(0, 3))


def sport_of(product_name: Column) -> Column:
    """The first sport whose name occurs in the product name."""
    found = F.lit(None).cast("string")
    for sport in reversed(SPORTS):
        found = F.when(product_name.contains(sport), F.lit(sport)).otherwise(found)
    return found


def person_habits(covers: DataFrame, product: DataFrame) -> DataFrame:
    """Number of covers per person and sport. ``covers`` has cert_no and product_code."""
    sports = product.select("product_code", sport_of(F.col("product_name")).alias("sport")).where("sport is not null")
    return full_certs(covers).join(sports, "product_code").groupBy("cert_no", "sport").agg(F.count(F.lit(1)).alias("covers"))


def person_children(
    insured: DataFrame, dependant: DataFrame, holder_covers: DataFrame, as_of: date, child_products: Sequence[str] = CHILD_PRODUCTS
) -> DataFrame:
    """Distinct (parent, child) with the child's nominal age and whether it goes to school.

    Children are the dependants of an insured person, and whoever a holder insures under a child product.
    """
    own = full_certs(insured).select(F.col("insured_id").alias("master_id"), F.col("cert_no").alias("parent"))
    first = own.join(full_certs(dependant, "slave_cert_no"), "master_id").select("parent", F.col("slave_cert_no").alias("child"))
    second = (
        full_certs(full_certs(holder_covers), "holder_cert_no")
        .where(F.col("product_name").isin(list(child_products)))
        .select(F.col("holder_cert_no").alias("parent"), F.col("cert_no").alias("child"))
    )
    age = cert.age_at(F.col("child"), F.lit(as_of))
    return (
        first.unionByName(second)
        .distinct()
        .withColumn("age", age)
        .withColumn("school", F.when(is_school_age(F.col("age")), "上学").otherwise("未上学"))
    )


def profile_union(base: DataFrame, phones: DataFrame, habits: DataFrame, children: DataFrame) -> DataFrame:
    """The base profile with counts of phones, the favourite sport and the number of children."""
    p = phones.groupBy("cert_no").agg(F.count(F.lit(1)).alias("phones"))
    h = habits.groupBy("cert_no").agg(F.max_by("sport", F.struct("covers", "sport")).alias("sport"))
    c = children.groupBy(F.col("parent").alias("cert_no")).agg(F.count(F.lit(1)).alias("children"))
    return base.join(p, "cert_no", "left").join(h, "cert_no", "left").join(c, "cert_no", "left")


def first_policy_facts(policy: DataFrame, insured: DataFrame, as_of: date) -> DataFrame:
    """Earliest policy per holder, and premium, policies and own covers in the 90 days that follow.

    ``policy`` has cert_no, policy_id, start_date, end_date, product_code, premium, channel, insurer.
    """
    facts = F.struct("policy_id", "start_date", "end_date", "product_code", "premium", "channel", "insurer")
    first = (
        policy.groupBy("cert_no")
        .agg(F.min_by(facts, F.struct("start_date", "policy_id")).alias("f"))
        .select("cert_no", "f.*")
        .withColumn("become_old", F.date_add("start_date", NEW_PERIOD))
        .withColumn("first_age", cert.age_at(F.col("cert_no"), F.col("start_date")))
        .withColumn("first_days", day_gap(F.col("start_date"), F.lit(as_of)))
    )
    until = first.select("cert_no", "become_old")
    bought = (
        policy.join(until, "cert_no")
        .where(F.col("start_date") <= F.col("become_old"))
        .groupBy("cert_no")
        .agg(F.sum("premium").alias("new_premium"), F.count(F.lit(1)).alias("new_policies"))
    )
    covered = (
        insured.select("cert_no", F.col("start_date").alias("cover_start"))
        .join(until, "cert_no")
        .where(F.col("cover_start") <= F.col("become_old"))
        .groupBy("cert_no")
        .agg(F.count(F.lit(1)).alias("new_covers"))
    )
    return first.join(bought, "cert_no", "left").join(covered, "cert_no", "left")


def mean4(total: Column, n: Column) -> Column:
    """Mean of a money sum, rounded half up to four places; null without rows."""
    return (total / F.nullif(n, F.lit(0))).cast(MONEY)


def last_policy_facts(policy: DataFrame, as_of: date) -> DataFrame:
    """Latest policy per holder, with sum, count and mean of premium in the last 90 days and over all time. One pass."""
    facts = F.struct("policy_id", "start_date", "product_code", "region_code")
    recent = F.col("start_date") >= F.date_sub(F.lit(as_of), NEW_PERIOD)
    city = F.when(F.length("l.region_code") == 6, F.concat(F.substring("l.region_code", 1, 4), F.lit("00")))
    return (
        policy.groupBy("cert_no")
        .agg(
            F.max_by(facts, F.struct("start_date", "policy_id")).alias("l"),
            F.sum(F.when(recent, F.col("premium"))).alias("recent_premium"),
            F.count_if(recent).alias("recent_policies"),
            F.sum("premium").alias("premium"),
            F.count(F.lit(1)).alias("policies"),
        )
        .select(
            "cert_no",
            F.col("l.policy_id").alias("last_policy_id"),
            F.col("l.start_date").alias("last_start"),
            F.col("l.product_code").alias("last_product"),
            city.alias("city_code"),
            day_gap(F.col("l.start_date"), F.lit(as_of)).alias("last_days"),
            "recent_premium",
            F.nullif("recent_policies", F.lit(0)).alias("recent_policies"),
            mean4(F.col("recent_premium"), F.col("recent_policies")).alias("recent_mean"),
            "premium",
            "policies",
            mean4(F.col("premium"), F.col("policies")).alias("mean"),
        )
    )


def last_end_date(policy: DataFrame) -> DataFrame:
    return policy.groupBy("cert_no").agg(F.max("end_date").alias("last_end"))


def insured_facts(policy: DataFrame, work: DataFrame, dependant: DataFrame, claim: DataFrame, as_of: date) -> DataFrame:
    """Per person: holder (1) or insured only (0), latest work type, cover now, number of covers, claims.

    Dependants (master_id, slave_cert_no) who are never insured themselves count with their master's cover. Rejected and
    withdrawn counts are null where there are none.
    """
    own = work.select("cert_no", "insured_id", "start_date", "end_date", "work_type", "work_risk")
    # the master's work goes along unused: with the same columns both sides read one shuffle of the work
    masters = own.drop("cert_no").withColumnRenamed("insured_id", "master_id")
    slaves = dependant.select("master_id", F.col("slave_cert_no").alias("cert_no")).join(masters, "master_id").withColumnRenamed("master_id", "insured_id")
    both = own.withColumn("own", F.lit(True)).unionByName(slaves.withColumn("own", F.lit(False)))
    start = F.coalesce("start_date", "end_date")
    end = F.coalesce("end_date", "start_date")
    now, mine, others = F.lit(as_of).between(start, end), F.col("own"), ~F.col("own")
    covered = (
        both.groupBy("cert_no")
        .agg(
            F.count("cert_no").alias("known"),  # counted, as a filter on the key would go below the shuffle and tell the sides apart
            F.max_by(F.when(mine, F.struct("work_type", "work_risk")), F.when(mine, F.struct(start, F.col("insured_id")))).alias("w"),
            F.max(F.when(mine, now)).alias("own_now"),
            F.max(F.when(others, now)).alias("slave_now"),
            F.count_if(mine).alias("own_covers"),
            F.count_if(others).alias("slave_covers"),
        )
        .where("known > 0")
        .select(
            "cert_no",
            "w",
            F.when(F.col("own_covers") > 0, F.col("own_now")).otherwise(F.col("slave_now")).alias("now"),
            F.when(F.col("own_covers") > 0, F.col("own_covers")).otherwise(F.col("slave_covers")).alias("covers"),
        )
    )
    holders = policy.select("cert_no").distinct().withColumn("holder", F.lit(True))
    claims = claim.groupBy(F.col("risk_cert_no").alias("cert_no")).agg(
        F.sum("payable").alias("claim_payable"),
        F.count(F.lit(1)).alias("claims"),
        F.nullif(F.count_if(F.col("case_status") == REJECTED), F.lit(0)).alias("rejected"),
        F.nullif(F.count_if(F.col("case_status") == WITHDRAWN), F.lit(0)).alias("withdrawn"),
    )
    return (
        holders.join(covered, "cert_no", "full")
        .join(claims, "cert_no", "left")
        .select(
            "cert_no",
            F.when(F.col("holder"), "1").otherwise("0").alias("cus_type"),
            F.col("w.work_type").alias("work_type"),
            F.col("w.work_risk").alias("work_risk"),
            F.when(F.col("covers").isNotNull(), F.when(F.col("now"), "在保").otherwise("不在保")).alias("covered"),
            "covers",
            "claim_payable",
            "claims",
            "rejected",
            "withdrawn",
        )
    )


def roles(policy: DataFrame, insured: DataFrame, dependant: DataFrame) -> DataFrame:
    """(cert_no, policy_id, role) of holders, insured people and their dependants."""
    own = insured.select("cert_no", "policy_id", F.lit("insured").alias("role"), "insured_id")
    slaves = dependant.select(F.col("master_id").alias("insured_id"), F.col("slave_cert_no").alias("cert_no")).join(
        own.select("insured_id", "policy_id"), "insured_id"
    )
    return (
        own.drop("insured_id")
        .unionByName(slaves.select("cert_no", "policy_id", F.lit("dependant").alias("role")))
        .unionByName(policy.select("cert_no", "policy_id", F.lit("holder").alias("role")))
    )


def potential_facts(policy: DataFrame, insured: DataFrame, dependant: DataFrame) -> DataFrame:
    """Per person: distinct live policies over all roles, and the products and channels met as insured or dependant.

    Products and channels come as sorted text; both are bounded by their dimension, and duplicates go before the shuffle.
    """
    facts = policy.where(F.col("policy_status").isin(LIVE_STATUSES)).select("policy_id", "product_code", "channel")
    seen = roles(policy, insured, dependant).where(F.col("cert_no").isNotNull()).join(facts, "policy_id")
    counted = seen.groupBy("cert_no").agg(F.countDistinct("policy_id").alias("policies"))

    def names(column: str) -> DataFrame:
        used = seen.where(F.col("role") != "holder").select("cert_no", column).distinct()
        return used.groupBy("cert_no").agg(F.array_join(F.array_sort(F.collect_set(column)), ",").alias(f"{column}s"))

    return counted.join(names("product_code"), "cert_no", "left").join(names("channel"), "cert_no", "left")


def merge_central(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Add the facts of new policies to stored ones: the earlier first policy, the later last one, sums and counts added.

    Both sides have cert_no, first_start, first_policy_id, last_start, last_policy_id, last_end, premium, policies.
    """
    whole = stored.unionByName(new)
    return (
        whole.groupBy("cert_no")
        .agg(
            F.min(F.struct("first_start", "first_policy_id")).alias("first"),
            F.max(F.struct("last_start", "last_policy_id")).alias("last"),
            F.max("last_end").alias("last_end"),
            F.sum("premium").alias("premium"),
            F.sum("policies").alias("policies"),
        )
        .select("cert_no", "first.*", "last.*", "last_end", "premium", "policies")
    )


def central_facts(policy: DataFrame) -> DataFrame:
    """The facts :func:`merge_central` adds up, from a set of policies."""
    key = F.struct("start_date", "policy_id")
    return (
        policy.groupBy("cert_no")
        .agg(F.min(key).alias("f"), F.max(key).alias("l"), F.max("end_date").alias("last_end"), F.sum("premium").alias("premium"), F.count(F.lit(1)).alias("policies"))
        .select(
            "cert_no", F.col("f.start_date").alias("first_start"), F.col("f.policy_id").alias("first_policy_id"),
            F.col("l.start_date").alias("last_start"), F.col("l.policy_id").alias("last_policy_id"), "last_end", "premium", "policies",
        )
    )


def sport_rate(covers: DataFrame, as_of: date) -> DataFrame:
    """Sport covers that started in the last 90 days. ``covers`` has cert_no, start, one_level."""
    recent = full_certs(covers).where((F.col("one_level") == SPORT_LINE) & (F.col("start") > F.date_sub(F.lit(as_of), 90)))
    return recent.groupBy("cert_no").agg(F.count(F.lit(1)).alias("sports_rate"))


def loves_travel(covers: DataFrame, as_of: date, products: Sequence[str] = TRAVEL_PRODUCTS) -> DataFrame:
    """``是`` for two or more travel covers in the last 180 days, null for one."""
    recent = full_certs(covers).where(F.col("product_code").isin(list(products)) & (F.col("start") > F.date_sub(F.lit(as_of), 180)))
    return recent.groupBy("cert_no").agg(F.when(F.count(F.lit(1)) >= 2, "是").alias("loves_travel"))


def perceives_risk(policy: DataFrame, claim: DataFrame) -> DataFrame:
    """Everybody who ever was a holder or a claimant."""
    people = full_certs(policy.select("cert_no")).unionByName(full_certs(claim.select(F.col("risk_cert_no").alias("cert_no"))))
    return people.distinct().withColumn("perceives", F.lit("是"))


def product_interest(covers: DataFrame, product: DataFrame, names: InterestProducts = InterestProducts()) -> DataFrame:
    """Interests read off the products a person is covered by.

    Covers shrink to one row per (person, product) first, then to one per person.
    """
    pairs = covers.groupBy("cert_no", "product_code").agg(F.min("start").alias("first"), F.count(F.lit(1)).alias("n"))
    d = F.col("product_name")
    yes = F.lit("是")
    frequent = F.sum(F.when(d.contains(names.frequent), F.col("n")))
    return (
        pairs.join(product.select("product_code", "product_name"), "product_code", "left")
        .groupBy("cert_no")
        .agg(
            F.max(F.when(d == names.cosmetics, yes)).alias("cosmetics"),
            F.date_format(F.min(F.when(d == names.wedding, F.col("first"))), "MM").alias("wedding_month"),
            F.max(F.when(d == names.ride_hailing, yes)).alias("ride_hailing"),
            F.nullif(F.count_if(d.isin(list(names.part_time))), F.lit(0)).alias("part_time"),
            F.max(F.when(d == names.landlord, yes)).alias("landlord"),
            F.when(frequent >= 12, yes).when(frequent.isNotNull(), "否").alias("frequent"),
        )
    )


def ride_histogram(rides: DataFrame, brands: Sequence[str] = BIKE_BRANDS) -> DataFrame:
    """Rides per (person, kind, value): time bucket, brand, weekday and day. ``rides`` has person, brand, at."""
    counted = (
        rides.where(F.col("brand").isin(list(brands)))
        .groupBy("person", "brand", F.to_date("at").alias("day"), F.hour("at").alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    kinds = {
        "time": ride_bucket(F.col("hour")),
        "brand": F.col("brand"),
        "weekday": weekday_monday_first(F.col("day")).cast("string"),
        "day": F.date_format("day", "yyyyMMdd"),
    }
    pairs = F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds.items()]))
    return counted.select("person", "n", pairs).groupBy("person", "kind", "value").agg(F.sum("n").alias("n"))


def ride_profile(histogram: DataFrame, as_of: date) -> DataFrame:
    """Riding days, most frequent bucket, brand and weekday, trips in 90 days, early or night type.

    Most frequent is the true mode; ties go to the larger text.
    """
    def mode(kind: str) -> Column:
        return F.max_by(F.when(F.col("kind") == kind, F.col("value")), F.when(F.col("kind") == kind, F.struct("n", "value")))

    is_day = F.col("kind") == "day"
    since = F.date_format(F.date_sub(F.lit(as_of), 90), "yyyyMMdd")
    result = histogram.groupBy("person").agg(
        F.count_if(is_day).alias("ride_days"),
        mode("time").alias("top_time"),
        mode("brand").alias("top_brand"),
        mode("weekday").alias("top_weekday"),
        F.sum(F.when(is_day & (F.col("value") > since), F.col("n")).otherwise(0)).alias("trips"),
    )
    kind = F.when(F.col("top_time") == "5-7时", "早期族").when(F.col("top_time").isin("23-1时", "1-3时", "3-5时"), "夜猫子")
    return result.withColumn("clock", kind)


def add_histograms(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy("person", "kind", "value").agg(F.sum("n").alias("n"))


def person_contacts(contacts: DataFrame) -> DataFrame:
    """Phones per person with the latest day each was seen and their position, newest first, and the sources that know the person.

    ``contacts`` has cert_no, mobile, start, end, source; certificates must be complete. Of phones seen last on one day the
    smaller text comes first; a person without a dated phone has one row without phone and position. Sources come joined
    by ``:``. A position is the phones of later days plus the place within the day, so no window holds more than a
    person's days or the phones of one day.
    """
    known = contacts.where(cert.is_full(F.col("cert_no")))
    seen = F.coalesce("start", "end")
    phones = (
        known.where(F.col("mobile").isNotNull() & seen.isNotNull()).groupBy("cert_no", "mobile").agg(F.max(seen).alias("latest"))
    )
    sources = known.groupBy("cert_no").agg(F.array_join(F.array_sort(F.collect_set("source")), ":").alias("sources"))
    by_day = Window.partitionBy("cert_no").orderBy(F.col("latest").desc())
    days = phones.groupBy("cert_no", "latest").agg(F.count(F.lit(1)).alias("phones"))
    days = days.select("cert_no", "latest", (F.sum("phones").over(by_day) - F.col("phones")).alias("later"))
    place = F.row_number().over(Window.partitionBy("cert_no", "latest").orderBy("mobile"))
    ordered = phones.withColumn("place", place).join(days, ["cert_no", "latest"])
    return sources.join(ordered.select("cert_no", "mobile", "latest", (F.col("later") + F.col("place")).alias("position")), "cert_no", "left")


def insurance_graph(policy: DataFrame, insured: DataFrame, dependant: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices (certificates) and edges (holder to insured by policy, insured to dependant by master id).

    The id is a 64-bit hash of the certificate; the certificate stays beside it, so a collision could be told apart.
    """
    held = (
        policy.select("policy_id", F.col("cert_no").alias("src"))
        .join(insured.select("policy_id", F.col("cert_no").alias("dst")), "policy_id")
        .select("src", "dst", F.col("policy_id").cast("string").alias("via"))
    )
    accompanied = (
        insured.select(F.col("insured_id").alias("master_id"), F.col("cert_no").alias("src"))
        .join(dependant.select("master_id", F.col("slave_cert_no").alias("dst")), "master_id")
        .select("src", "dst", F.col("master_id").alias("via"))
    )
    edges = held.unionByName(accompanied).where(F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct()
    people = (
        policy.select("cert_no").unionByName(insured.select("cert_no")).unionByName(dependant.select(F.col("slave_cert_no").alias("cert_no")))
    )
    vertices = people.where(F.col("cert_no").isNotNull()).distinct()
    return (
        vertices.select(F.xxhash64("cert_no").alias("id"), "cert_no"),
        edges.select(F.xxhash64("src").alias("src_id"), F.xxhash64("dst").alias("dst_id"), "src", "dst", "via"),
    )
