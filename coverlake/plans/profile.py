"""Person profiles, life-cycle and the insurance graph."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.adapters import AS_OF, Tables
from coverlake.operators import counted as C
from coverlake.operators import lifecycle as L
from coverlake.operators import profile as P
from coverlake.operators import quality as Q
from coverlake.operators.incremental import label_merge
from coverlake.oracle import CTES, TODAY, age_sql, gap_sql, half_up, mobile_sql
from coverlake.plans.claims import work
from coverlake.registry import query

SNAPSHOT = date(2000, 6, 30)
NEW_SINCE = date(2001, 6, 1)
RIDE_DAY = date(2024, 4, 10)
RIDE_SPLIT = date(2024, 1, 16)
RIDE_BRANDS = ["click", "view", "purchase", "signup"]
CHILD_PRODUCTS = ["家庭健康险"]
TRAVEL = ["HOUSEHOLD", "BUILDING"]
INTEREST = P.InterestProducts(
    cosmetics="家庭健康险", wedding="建筑工人意外险", ride_hailing="雇主责任险", landlord="马拉松意外险", frequent="骑行", part_time=("骑行意外险", "马拉松意外险")
)

CTES["x_holder"] = "SELECT *, holder_cert_no AS cert_no, first_premium AS premium FROM d_policy"
CTES["x_slave"] = """
SELECT s.*, slave_cert_no AS cert_no, i.policy_id, i.start_date, i.end_date FROM d_dependant s JOIN d_insured i ON i.insured_id = s.master_id"""
CTES["x_people"] = """
SELECT cert_no, min(CASE WHEN name IN ('', 'NULL') THEN NULL ELSE name END) AS name FROM (
  SELECT cert_no, 'P' || CAST(person_id AS VARCHAR) AS name FROM d_insured
  UNION ALL SELECT slave_cert_no, slave_name FROM d_dependant
  UNION ALL SELECT cert_no, holder_name FROM x_holder)
WHERE length(cert_no) = 18 AND NOT contains(cert_no, '*') GROUP BY 1"""
_AGE = age_sql("cert_no", TODAY)
_M, _D = "CAST(substr(cert_no, 11, 2) AS INTEGER)", "CAST(substr(cert_no, 13, 2) AS INTEGER)"


def _person_base(people: str) -> str:
    return f"""
SELECT b.*, province AS home_province, city AS home_city FROM (
SELECT cert_no, name, CASE CAST(substr(cert_no, 17, 1) AS INTEGER) % 2 WHEN 1 THEN '1' ELSE '2' END AS gender, substr(cert_no, 7, 8) AS birthday,
  {_AGE} AS age, substr(cert_no, 9, 1) || '0后' AS decade,
  CASE WHEN {_AGE} < 12 THEN '儿童' WHEN {_AGE} < 18 THEN '少年' WHEN {_AGE} < 28 THEN '青年' WHEN {_AGE} < 45 THEN '壮年' WHEN {_AGE} < 60 THEN '中年' ELSE '老年' END AS age_band,
  CASE WHEN {_AGE} > 60 THEN '退休' ELSE '未退休' END AS retired, substr(cert_no, 1, 4) || '00' AS home_code,
  CASE WHEN {_D} < [20, 19, 21, 20, 21, 22, 23, 23, 23, 24, 23, 22][{_M}] THEN [10, 11, 12, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10][{_M}]
       ELSE [10, 11, 12, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10][{_M} + 1] END AS star_sign
FROM {people}) b LEFT JOIN d_area a ON a.code = b.home_code"""


CTES["x_base"] = _person_base("x_people")
CTES["x_phone"] = f"""
SELECT mobile, min(province) AS phone_province, min(city) AS phone_city, min(operator) AS operator FROM (
  SELECT {mobile_sql('holder_id')} AS mobile, province, city, CASE WHEN balance >= 0 THEN 'OP' || CAST(length(city) AS VARCHAR) END AS operator FROM d_customer)
GROUP BY 1"""
CTES["x_phones"] = """
SELECT c.cert_no, c.mobile, phone_province, phone_city, operator FROM (
  SELECT DISTINCT cert_no, mobile FROM (SELECT cert_no, mobile FROM d_insured UNION ALL SELECT cert_no, holder_mobile FROM x_holder) WHERE length(cert_no) = 18) c
LEFT JOIN x_phone p ON p.mobile = c.mobile
WHERE (phone_province IS NULL AND phone_city IS NULL AND operator IS NULL) OR (phone_province IS NOT NULL AND phone_city IS NOT NULL AND operator IS NOT NULL)"""
CTES["x_cover_products"] = """
SELECT i.cert_no, i.insured_id, i.policy_id, coalesce(i.start_date, i.end_date) AS start, p.product_code, product_name, one_level, p.holder_cert_no
FROM d_insured i JOIN d_policy p ON p.policy_id = i.policy_id LEFT JOIN d_product r ON r.product_code = p.product_code"""
CTES["x_habits"] = """
SELECT cert_no, sport, count(*) AS covers FROM (SELECT cert_no,
  CASE """ + " ".join(f"WHEN contains(product_name, '{s}') THEN '{s}'" for s in P.SPORTS) + """ END AS sport FROM x_cover_products WHERE length(cert_no) = 18)
WHERE sport IS NOT NULL GROUP BY 1, 2"""
CTES["x_children"] = f"""
SELECT parent, child, {age_sql('child', TODAY)} AS age FROM (
  SELECT i.cert_no AS parent, slave_cert_no AS child FROM d_insured i JOIN d_dependant s ON s.master_id = i.insured_id
  UNION SELECT holder_cert_no, cert_no FROM x_cover_products WHERE product_name IN ('家庭健康险'))
WHERE length(parent) = 18 AND length(child) = 18"""
CTES["x_profile"] = """
SELECT b.*, p.phones, h.sport, c.children FROM x_base b
LEFT JOIN (SELECT cert_no, count(*) AS phones FROM x_phones GROUP BY 1) p ON p.cert_no = b.cert_no
LEFT JOIN (SELECT cert_no, sport FROM x_habits QUALIFY row_number() OVER (PARTITION BY cert_no ORDER BY covers DESC, sport DESC) = 1) h ON h.cert_no = b.cert_no
LEFT JOIN (SELECT parent, count(*) AS children FROM x_children GROUP BY 1) c ON c.parent = b.cert_no"""


def holders(t: Tables) -> DataFrame:
    """Policies keyed by the certificate of their holder."""
    return t.policy.withColumnsRenamed({"holder_cert_no": "cert_no", "first_premium": "premium"})


def people(t: Tables) -> DataFrame:
    own = t.insured.select("cert_no", F.concat(F.lit("P"), F.col("person_id").cast("string")).alias("name"))
    slaves = t.dependant.select(F.col("slave_cert_no").alias("cert_no"), F.col("slave_name").alias("name"))
    return P.people_of(own, slaves, holders(t).select("cert_no", F.col("holder_name").alias("name")))


def phone_dimension(t: Tables) -> DataFrame:
    operator = F.when(F.col("balance") >= 0, F.concat(F.lit("OP"), F.length("city").cast("string")))
    return t.customer.groupBy(F.col("holder_mobile").alias("mobile")).agg(
        F.min("province").alias("phone_province"), F.min("city").alias("phone_city"), F.min(operator).alias("operator")
    )


def phones(t: Tables) -> DataFrame:
    seen = t.insured.select("cert_no", "mobile").unionByName(holders(t).select("cert_no", F.col("holder_mobile").alias("mobile")))
    return P.person_phones(seen, phone_dimension(t))


def cover_products(t: Tables) -> DataFrame:
    """Covers with the product of their policy."""
    policy = t.policy.select("policy_id", "product_code", "holder_cert_no")
    covers = t.insured.select("insured_id", "policy_id", "cert_no", F.coalesce("start_date", "end_date").alias("start"))
    return covers.join(policy, "policy_id").join(t.product, "product_code", "left")


def habits(t: Tables) -> DataFrame:
    return P.person_habits(cover_products(t).select("cert_no", "product_code"), t.product)


def children(t: Tables) -> DataFrame:
    return P.person_children(t.insured, t.dependant, cover_products(t), AS_OF, CHILD_PRODUCTS)


def profile(t: Tables) -> DataFrame:
    return P.profile_union(P.person_base(people(t), t.area, AS_OF), phones(t), habits(t), children(t))


BASE = ("cert_no:str name:str gender:str birthday:str age:long decade:str age_band:str retired:str home_code:str star_sign:long "
        "home_province:str home_city:str")


@query("person_base", BASE, "SELECT * FROM x_base")
def person_base(t: Tables) -> DataFrame:
    return P.person_base(people(t), t.area, AS_OF)


@query("person_phones", "cert_no:str mobile:str phone_province:str phone_city:str operator:str", "SELECT * FROM x_phones")
def person_phones(t: Tables) -> DataFrame:
    return phones(t)


@query("person_habits", "cert_no:str sport:str covers:long", "SELECT * FROM x_habits")
def person_habits(t: Tables) -> DataFrame:
    return habits(t)


@query("person_children", "parent:str child:str age:long school:str",
       "SELECT *, CASE WHEN age BETWEEN 6 AND 15 THEN '上学' ELSE '未上学' END AS school FROM x_children")
def person_children(t: Tables) -> DataFrame:
    return children(t)


@query("profile_union", BASE + " phones:long sport:str children:long", "SELECT * FROM x_profile")
def profile_union(t: Tables) -> DataFrame:
    return profile(t)


CTES["x_inc_certs"] = f"""
SELECT DISTINCT cert_no FROM (
  SELECT cert_no FROM d_insured WHERE policy_id IN (SELECT policy_id FROM d_policy WHERE start_date > DATE '{SNAPSHOT}')
  UNION ALL SELECT cert_no FROM x_slave WHERE policy_id IN (SELECT policy_id FROM d_policy WHERE start_date > DATE '{SNAPSHOT}')
  UNION ALL SELECT cert_no FROM x_holder WHERE start_date > DATE '{SNAPSHOT}')"""


@query("profile_increment", "cert_no:str gender:str age:long age_band:str marks:long", f"""
WITH old AS (SELECT cert_no, gender, {age_sql('cert_no', f"DATE '{SNAPSHOT}'")} AS age, 1 AS marks FROM x_base),
new AS (SELECT b.cert_no, gender, age, age_band FROM x_base b JOIN x_inc_certs i ON i.cert_no = b.cert_no)
SELECT o.cert_no, o.gender, coalesce(n.age, o.age) AS age,
  coalesce(n.age_band, CASE WHEN o.age < 12 THEN '儿童' WHEN o.age < 18 THEN '少年' WHEN o.age < 28 THEN '青年' WHEN o.age < 45 THEN '壮年' WHEN o.age < 60 THEN '中年' ELSE '老年' END) AS age_band,
  o.marks FROM old o LEFT JOIN new n ON n.cert_no = o.cert_no""")
def profile_increment(t: Tables) -> DataFrame:
    """Stored profiles as of the snapshot, refreshed for everybody on a policy that started since."""
    everybody = people(t)
    stored = P.person_base(everybody, t.area, SNAPSHOT).withColumn("marks", F.lit(1))
    fresh = t.policy.where(F.col("start_date") > F.lit(SNAPSHOT)).select("policy_id")
    touched = P.roles(holders(t), t.insured, t.dependant).join(fresh, "policy_id", "left_semi").select("cert_no").distinct()
    return label_merge(stored, P.person_base(everybody.join(touched, "cert_no", "left_semi"), t.area, AS_OF), "cert_no")


CTES["x_first"] = """
SELECT *, start_date + 90 AS become_old FROM x_holder QUALIFY row_number() OVER (PARTITION BY cert_no ORDER BY start_date, policy_id) = 1"""


@query("first_policy_facts", "cert_no:str policy_id:long start_date:str end_date:str product_code:str premium:double channel:str insurer:str "
       "become_old:str first_age:long first_days:long new_premium:double new_policies:long new_covers:long", f"""
SELECT f.cert_no, f.policy_id, f.start_date, f.end_date, f.product_code, f.premium, f.channel, f.insurer, f.become_old,
  {age_sql('f.cert_no', 'f.start_date')} AS first_age, {gap_sql('f.start_date', TODAY)} AS first_days, new_premium, new_policies, new_covers
FROM x_first f
LEFT JOIN (SELECT h.cert_no, sum(h.premium) AS new_premium, count(*) AS new_policies FROM x_holder h JOIN x_first f ON f.cert_no = h.cert_no
  WHERE h.start_date <= f.become_old GROUP BY 1) b ON b.cert_no = f.cert_no
LEFT JOIN (SELECT i.cert_no, count(*) AS new_covers FROM d_insured i JOIN x_first f ON f.cert_no = i.cert_no
  WHERE i.start_date <= f.become_old GROUP BY 1) c ON c.cert_no = f.cert_no""")
def first_policy_facts(t: Tables) -> DataFrame:
    return P.first_policy_facts(holders(t), t.insured, AS_OF)


@query("last_policy_facts", "cert_no:str last_policy_id:long last_start:str last_product:str city_code:str last_days:long recent_premium:double "
       "recent_policies:long recent_mean:double premium:double policies:long mean:double", f"""
SELECT l.cert_no, l.policy_id AS last_policy_id, l.start_date AS last_start, l.product_code AS last_product,
  CASE WHEN length(l.region_code) = 6 THEN substr(l.region_code, 1, 4) || '00' END AS city_code, {gap_sql('l.start_date', TODAY)} AS last_days,
  r.recent_premium, r.recent_policies, {half_up('r.recent_premium', 'r.recent_policies')} AS recent_mean, a.premium, a.policies, {half_up('a.premium', 'a.policies')} AS mean
FROM (SELECT * FROM x_holder QUALIFY row_number() OVER (PARTITION BY cert_no ORDER BY start_date DESC, policy_id DESC) = 1) l
JOIN (SELECT cert_no, sum(premium) AS premium, count(*) AS policies FROM x_holder GROUP BY 1) a ON a.cert_no = l.cert_no
LEFT JOIN (SELECT cert_no, sum(premium) AS recent_premium, count(*) AS recent_policies FROM x_holder WHERE start_date >= {TODAY} - 90 GROUP BY 1) r ON r.cert_no = l.cert_no""")
def last_policy_facts(t: Tables) -> DataFrame:
    return P.last_policy_facts(holders(t), AS_OF)


@query("last_end_date", "cert_no:str last_end:str", "SELECT cert_no, max(end_date) AS last_end FROM x_holder GROUP BY 1")
def last_end_date(t: Tables) -> DataFrame:
    return P.last_end_date(holders(t))


@query("insured_facts", "cert_no:str cus_type:str work_type:str work_risk:str covered:str covers:long claim_payable:double claims:long "
       "rejected:long withdrawn:long", f"""
WITH w AS (SELECT cert_no, insured_id, coalesce(start_date, end_date) AS s, coalesce(end_date, start_date) AS e, work_type, work_risk FROM x_work
  UNION ALL SELECT cert_no, master_id, coalesce(start_date, end_date), coalesce(end_date, start_date), NULL, NULL FROM x_slave
  WHERE cert_no NOT IN (SELECT cert_no FROM d_insured)),
c AS (SELECT cert_no, max({TODAY} BETWEEN s AND e) AS now, count(*) AS covers FROM w GROUP BY 1),
j AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY cert_no ORDER BY s DESC, insured_id DESC) = 1),
h AS (SELECT DISTINCT cert_no FROM x_holder),
k AS (SELECT risk_cert_no, sum(payable) AS claim_payable, count(*) AS claims, nullif(count(*) FILTER (case_status = '拒赔'), 0) AS rejected,
  nullif(count(*) FILTER (case_status = '处理中'), 0) AS withdrawn FROM d_claim GROUP BY 1)
SELECT coalesce(h.cert_no, c.cert_no) AS cert_no, CASE WHEN h.cert_no IS NOT NULL THEN '1' ELSE '0' END AS cus_type, j.work_type, j.work_risk,
  CASE WHEN covers IS NULL THEN NULL WHEN now THEN '在保' ELSE '不在保' END AS covered, covers, claim_payable, claims, rejected, withdrawn
FROM h FULL JOIN c ON c.cert_no = h.cert_no LEFT JOIN j ON j.cert_no = c.cert_no LEFT JOIN k ON k.risk_cert_no = coalesce(h.cert_no, c.cert_no)""")
def insured_facts(t: Tables) -> DataFrame:
    # the test tables know no withdrawn case; open ones stand in for them
    claims = t.claim.replace({"处理中": P.WITHDRAWN}, subset=["case_status"])
    return P.insured_facts(holders(t), work(t), t.dependant, claims, AS_OF)


@query("potential_facts", "cert_no:str policies:long product_codes:str channels:str", """
WITH r AS (SELECT cert_no, policy_id, false AS holder FROM d_insured UNION ALL SELECT cert_no, policy_id, false FROM x_slave
  UNION ALL SELECT cert_no, policy_id, true FROM x_holder),
s AS (SELECT r.*, product_code, channel FROM r JOIN d_policy p ON p.policy_id = r.policy_id WHERE policy_status IN (0, 1, -1))
SELECT cert_no, count(DISTINCT policy_id) AS policies, string_agg(DISTINCT product_code, ',' ORDER BY product_code) FILTER (NOT holder) AS product_codes,
  string_agg(DISTINCT channel, ',' ORDER BY channel) FILTER (NOT holder) AS channels FROM s GROUP BY 1""")
def potential_facts(t: Tables) -> DataFrame:
    return P.potential_facts(holders(t), t.insured, t.dependant)


@query("central_increment", "cert_no:str first_start:str first_policy_id:long last_start:str last_policy_id:long last_end:str premium:double policies:long", """
SELECT cert_no, min(start_date) AS first_start, arg_min(policy_id, (start_date, policy_id)) AS first_policy_id, max(start_date) AS last_start,
  arg_max(policy_id, (start_date, policy_id)) AS last_policy_id, max(end_date) AS last_end, sum(premium) AS premium, count(*) AS policies
FROM x_holder GROUP BY 1""")
def central_increment(t: Tables) -> DataFrame:
    """Facts stored at the snapshot plus the facts of newer policies; must equal a computation from scratch."""
    before = F.col("start_date") <= F.lit(SNAPSHOT)
    old, new = (P.central_facts(holders(t).where(c)) for c in (before, ~before))
    return P.merge_central(old, new)


# three snapshots: later ones know newer policies, have lost cancelled ones, and the last has other premiums for some
SNAPSHOTS = [date(1999, 6, 30), date(2000, 6, 30), date(2002, 1, 1)]
CANCELLED = date(1998, 12, 31)
CTES["x_final"] = f"""
SELECT policy_id, holder_cert_no AS cert_no, start_date, end_date, product_code, channel, policy_status,
  CASE WHEN policy_id % 17 = 0 THEN first_premium * 2 ELSE first_premium END AS premium
FROM d_policy WHERE NOT (policy_id % 13 = 0 AND start_date <= DATE '2000-01-31')"""
CTES["x_final_cover"] = """
SELECT i.cert_no, i.insured_id, i.policy_id, coalesce(i.start_date, i.end_date) AS s, coalesce(i.end_date, i.start_date) AS e, i.work_type
FROM d_insured_work i JOIN x_final p ON p.policy_id = i.policy_id"""
CTES["x_final_slave"] = """
SELECT d.slave_cert_no AS cert_no, c.policy_id, c.s, c.e FROM d_dependant d JOIN x_final_cover c ON c.insured_id = d.master_id"""
CTES["x_final_roles"] = """
SELECT r.*, p.product_code, p.channel FROM (
  SELECT cert_no, policy_id, false AS holder FROM x_final_cover UNION ALL SELECT cert_no, policy_id, false FROM x_final_slave
  UNION ALL SELECT cert_no, policy_id, true FROM x_final) r JOIN x_final p ON p.policy_id = r.policy_id WHERE p.policy_status IN (0, 1, -1)"""


def snapshots(t: Tables) -> list[tuple[DataFrame, DataFrame, DataFrame, DataFrame]]:
    """(policy, work, dependant, claim) as of each snapshot day."""
    columns = ["policy_id", "cert_no", "start_date", "end_date", "product_code", "channel", "policy_status", "premium"]
    policy = holders(t).select(*columns)
    out = F.pmod("policy_id", F.lit(13)) == 0
    gone = [F.lit(False), out & (F.col("start_date") <= F.lit(CANCELLED)), out & (F.col("start_date") <= F.lit(date(2000, 1, 31)))]
    dearer = F.when(F.pmod("policy_id", F.lit(17)) == 0, F.col("premium") * 2).otherwise(F.col("premium")).cast("decimal(14,4)")
    claims = t.claim.replace({"处理中": P.WITHDRAWN}, subset=["case_status"])
    work = t.insured_work.withColumn("work_risk", F.lit(None).cast("string"))
    made = []
    for k, (day, lost) in enumerate(zip(SNAPSHOTS, gone)):
        known = policy.where((F.col("start_date") <= F.lit(day)) & ~F.coalesce(lost, F.lit(False)))
        made.append((known.withColumn("premium", dearer) if k == 2 else known, work, t.dependant, claims))
    return made


def central_state(t: Tables) -> DataFrame:
    """The counted state of the first snapshot, carried on by what changed from each snapshot to the next."""
    first, *later = snapshots(t)
    moved = [C.changes(a, b) for a, b in zip([first, *later], later)]
    return C.merged(C.contributions(*first), *moved)


@query("central_counted", "cert_no:str cus_type:str first_start:str first_policy_id:long last_start:str last_policy_id:long last_end:str premium:double "
       "held:long policies:long products:str channels:long covers:long covered:str work_type:str claims:long claim_payable:double rejected:long withdrawn:long", f"""
WITH h AS (SELECT cert_no, min(start_date) AS first_start, arg_min(policy_id, (start_date, policy_id)) AS first_policy_id, max(start_date) AS last_start,
  arg_max(policy_id, (start_date, policy_id)) AS last_policy_id, max(end_date) AS last_end, sum(premium) AS premium, count(*) AS held FROM x_final GROUP BY 1),
r AS (SELECT cert_no, count(DISTINCT policy_id) AS policies, string_agg(DISTINCT product_code, ',' ORDER BY product_code) FILTER (NOT holder) AS products,
  count(DISTINCT channel) FILTER (NOT holder) AS channels FROM x_final_roles GROUP BY 1),
o AS (SELECT cert_no, count(*) AS covers, max({TODAY} BETWEEN s AND e) AS now, arg_max(coalesce(work_type, ''), (coalesce(s, DATE '0001-01-01'), insured_id)) AS work_type FROM x_final_cover GROUP BY 1),
d AS (SELECT cert_no, count(*) AS covers, max({TODAY} BETWEEN s AND e) AS now FROM x_final_slave GROUP BY 1),
k AS (SELECT risk_cert_no AS cert_no, count(*) AS claims, sum(payable) AS claim_payable, nullif(count(*) FILTER (case_status = '拒赔'), 0) AS rejected,
  nullif(count(*) FILTER (case_status = '处理中'), 0) AS withdrawn FROM d_claim c JOIN x_final p ON p.policy_id = c.policy_id GROUP BY 1),
people AS (SELECT cert_no FROM h UNION SELECT cert_no FROM o UNION SELECT cert_no FROM d UNION SELECT cert_no FROM k)
SELECT b.cert_no, CASE WHEN h.cert_no IS NULL THEN '0' ELSE '1' END AS cus_type, first_start, first_policy_id, last_start, last_policy_id, last_end, premium, held,
  coalesce(policies, 0) AS policies, products, coalesce(channels, 0) AS channels, coalesce(o.covers, d.covers) AS covers,
  CASE WHEN coalesce(o.covers, d.covers) IS NULL THEN NULL WHEN coalesce(o.now, d.now) THEN '在保' ELSE '不在保' END AS covered,
  nullif(o.work_type, '') AS work_type, claims, claim_payable, rejected, withdrawn
FROM people b LEFT JOIN h ON h.cert_no = b.cert_no LEFT JOIN r ON r.cert_no = b.cert_no LEFT JOIN o ON o.cert_no = b.cert_no
LEFT JOIN d ON d.cert_no = b.cert_no LEFT JOIN k ON k.cert_no = b.cert_no WHERE b.cert_no IS NOT NULL""")
def central_counted(t: Tables) -> DataFrame:
    """Facts after two increments with new, changed and cancelled policies; must equal a computation from scratch."""
    return C.facts(central_state(t), AS_OF)


@query("central_channels", "cert_no:str channel:str times:long", """
SELECT cert_no, channel, count(*) AS times FROM x_final_roles WHERE NOT holder AND cert_no IS NOT NULL AND channel IS NOT NULL GROUP BY ALL""")
def central_channels(t: Tables) -> DataFrame:
    return C.channels(central_state(t))


@query("sport_rate", "cert_no:str sports_rate:long", f"""
SELECT cert_no, count(*) AS sports_rate FROM x_cover_products WHERE length(cert_no) = 18 AND one_level = '体育' AND start > {TODAY} - 90 GROUP BY 1""")
def sport_rate(t: Tables) -> DataFrame:
    return P.sport_rate(cover_products(t), AS_OF)


@query("loves_travel", "cert_no:str loves_travel:str", f"""
SELECT cert_no, CASE WHEN count(*) >= 2 THEN '是' END AS loves_travel FROM x_cover_products
WHERE length(cert_no) = 18 AND product_code IN ('HOUSEHOLD', 'BUILDING') AND start > {TODAY} - 180 GROUP BY 1""")
def loves_travel(t: Tables) -> DataFrame:
    return P.loves_travel(cover_products(t), AS_OF, TRAVEL)


@query("perceives_risk", "cert_no:str perceives:str", """
SELECT cert_no, '是' AS perceives FROM (SELECT cert_no FROM x_holder UNION SELECT risk_cert_no FROM d_claim) WHERE length(cert_no) = 18""")
def perceives_risk(t: Tables) -> DataFrame:
    return P.perceives_risk(holders(t), t.claim)


@query("product_interest", "cert_no:str cosmetics:str wedding_month:str ride_hailing:str part_time:long landlord:str frequent:str", """
SELECT cert_no, max(CASE WHEN product_name = '家庭健康险' THEN '是' END) AS cosmetics,
  strftime(min(CASE WHEN product_name = '建筑工人意外险' THEN start END), '%m') AS wedding_month,
  max(CASE WHEN product_name = '雇主责任险' THEN '是' END) AS ride_hailing,
  nullif(count(DISTINCT CASE WHEN product_name IN ('骑行意外险', '马拉松意外险') THEN product_code END), 0) AS part_time,
  max(CASE WHEN product_name = '马拉松意外险' THEN '是' END) AS landlord,
  CASE WHEN count(*) FILTER (contains(product_name, '骑行')) >= 12 THEN '是' WHEN count(*) FILTER (contains(product_name, '骑行')) > 0 THEN '否' END AS frequent
FROM x_cover_products GROUP BY 1""")
def product_interest(t: Tables) -> DataFrame:
    return P.product_interest(cover_products(t).select("cert_no", "product_code", "start"), t.product, INTEREST)


CTES["x_ride"] = """
SELECT user_id AS person, event_type AS brand, ts, CAST(ts AS DATE) AS day, hour(ts) AS h FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup')"""
CTES["x_ride_kinds"] = """
SELECT person, 'time' AS kind, CASE WHEN h BETWEEN 1 AND 22 THEN CAST(h - (h + 1) % 2 AS VARCHAR) || '-' || CAST(h - (h + 1) % 2 + 2 AS VARCHAR) || '时' ELSE '23-1时' END AS value FROM x_ride
UNION ALL SELECT person, 'brand', brand FROM x_ride UNION ALL SELECT person, 'weekday', CAST(isodow(ts) AS VARCHAR) FROM x_ride
UNION ALL SELECT person, 'day', strftime(day, '%Y%m%d') FROM x_ride"""
CTES["x_ride_hist"] = "SELECT person, kind, value, count(*) AS n FROM x_ride_kinds GROUP BY ALL"
CTES["x_ride_profile"] = f"""
WITH m AS (SELECT person, kind, value FROM x_ride_hist QUALIFY row_number() OVER (PARTITION BY person, kind ORDER BY n DESC, value DESC) = 1),
r AS (SELECT person, count(DISTINCT day) AS ride_days, count(*) FILTER (day > DATE '{RIDE_DAY}' - 90) AS trips FROM x_ride GROUP BY 1)
SELECT r.*, t.value AS top_time, b.value AS top_brand, w.value AS top_weekday,
  CASE WHEN t.value = '5-7时' THEN '早期族' WHEN t.value IN ('23-1时', '1-3时', '3-5时') THEN '夜猫子' END AS clock
FROM r JOIN m t ON t.person = r.person AND t.kind = 'time' JOIN m b ON b.person = r.person AND b.kind = 'brand'
JOIN m w ON w.person = r.person AND w.kind = 'weekday'"""
RIDE = "person:long ride_days:long top_time:str top_brand:str top_weekday:str trips:long clock:str"


def rides(t: Tables) -> DataFrame:
    return t.raw("events").select(F.col("user_id").alias("person"), F.col("event_type").alias("brand"), F.col("ts").alias("at"))


@query("ride_profile", RIDE, "SELECT * FROM x_ride_profile")
def ride_profile(t: Tables) -> DataFrame:
    return P.ride_profile(P.ride_histogram(rides(t), RIDE_BRANDS), RIDE_DAY)


@query("ride_histogram", "person:long kind:str value:str n:long", "SELECT * FROM x_ride_hist")
def ride_histogram(t: Tables) -> DataFrame:
    return P.ride_histogram(rides(t), RIDE_BRANDS)


@query("ride_profile_increment", RIDE, "SELECT * FROM x_ride_profile")
def ride_profile_increment(t: Tables) -> DataFrame:
    """Histograms stored at the split day plus those of newer rides; must equal a computation from scratch."""
    early = F.col("at") < F.lit(RIDE_SPLIT)
    old, new = (P.ride_histogram(rides(t).where(c), RIDE_BRANDS) for c in (early, ~early))
    return P.ride_profile(P.add_histograms(old, new), RIDE_DAY)


CTES["x_contacts"] = """
SELECT cert_no, mobile, start_date AS s, end_date AS e, 'website' AS source FROM d_insured
UNION ALL SELECT holder_cert_no, holder_mobile, start_date, end_date, 'inter' FROM d_policy
UNION ALL SELECT risk_cert_no, NULL, risk_day, NULL, 'other' FROM d_claim"""


@query("person_contacts", "cert_no:str mobile:str latest:str position:long sources:str", """
WITH k AS (SELECT * FROM x_contacts WHERE regexp_full_match(cert_no, '[0-9]{17}[0-9xX]')),
p AS (SELECT cert_no, mobile, max(coalesce(s, e)) AS latest FROM k WHERE mobile IS NOT NULL AND coalesce(s, e) IS NOT NULL GROUP BY 1, 2),
o AS (SELECT cert_no, string_agg(DISTINCT source, ':' ORDER BY source) AS sources FROM k GROUP BY 1)
SELECT o.cert_no, mobile, latest, CASE WHEN mobile IS NOT NULL THEN row_number() OVER (PARTITION BY p.cert_no ORDER BY latest DESC, mobile) END AS position,
  sources FROM o LEFT JOIN p ON p.cert_no = o.cert_no""")
def person_contacts(t: Tables) -> DataFrame:
    none_day, none_text = F.lit(None).cast("date"), F.lit(None).cast("string")
    web = t.insured.select("cert_no", "mobile", F.col("start_date").alias("start"), F.col("end_date").alias("end"), F.lit("website").alias("source"))
    inter = holders(t).select("cert_no", F.col("holder_mobile").alias("mobile"), F.col("start_date").alias("start"), F.col("end_date").alias("end"), F.lit("inter").alias("source"))
    other = t.claim.select(F.col("risk_cert_no").alias("cert_no"), none_text.alias("mobile"), F.col("risk_day").alias("start"), none_day.alias("end"), F.lit("other").alias("source"))
    return P.person_contacts(web.unionByName(inter).unionByName(other))


@query("other_profile", BASE, "SELECT * FROM (" + _person_base(
    "(SELECT risk_cert_no AS cert_no, min(substr(risk_cert_no, 1, 6)) AS name FROM d_claim WHERE length(risk_cert_no) = 18 AND NOT contains(risk_cert_no, '*') GROUP BY 1)") + ")")
def other_profile(t: Tables) -> DataFrame:
    """The base profile of people known from another source only: the claims."""
    named = t.claim.select(F.col("risk_cert_no").alias("cert_no"), F.substring("risk_cert_no", 1, 6).alias("name"))
    return P.person_base(P.people_of(named), t.area, AS_OF)


CTES["x_labels"] = """
SELECT cert_no, CAST(min(holder_id) % 6 AS VARCHAR) AS state,
  CASE WHEN min(holder_id) % 6 > 0 THEN min(start_date) + CAST(30 * (min(holder_id) % 6) AS INTEGER) END AS since, min(start_date) + 90 AS become_old
FROM x_holder GROUP BY 1"""
CTES["x_span"] = """
SELECT l.cert_no, l.start_date AS s, l.end_date AS e, greatest(n.newest, l.start_date) AS newest
FROM (SELECT * FROM x_holder QUALIFY row_number() OVER (PARTITION BY cert_no ORDER BY end_date DESC, policy_id DESC) = 1) l
JOIN (SELECT cert_no, max(start_date) AS newest FROM x_holder GROUP BY 1) n ON n.cert_no = l.cert_no"""
CTES["x_new_holder"] = f"SELECT DISTINCT cert_no FROM x_holder WHERE start_date >= DATE '{NEW_SINCE}'"


def labels(t: Tables) -> DataFrame:
    """Stored life-cycle labels; the state is made up from the holder's id."""
    state = F.pmod(F.min("holder_id"), F.lit(6))
    first = F.array(F.struct(F.lit("0").alias("state"), F.lit(None).cast("date").alias("since")))
    rows = holders(t).groupBy("cert_no").agg(state.cast("int").alias("n"), F.min("start_date").alias("first"))
    return rows.select(
        "cert_no",
        F.col("n").cast("string").alias("state"),
        F.when(F.col("n") > 0, F.date_add("first", F.col("n") * 30)).alias("since"),
        F.date_add("first", 90).alias("become_old"),
        first.alias("history"),
    )


def new_holders(t: Tables) -> DataFrame:
    return holders(t).where(F.col("start_date") >= F.lit(NEW_SINCE)).select("cert_no").distinct()


def history_text(df: DataFrame) -> DataFrame:
    """History as text, ``state:since`` joined by commas."""
    step = lambda h: F.concat(h["state"], F.lit(":"), F.coalesce(h["since"].cast("string"), F.lit("")))
    return df.withColumn("history", F.array_join(F.transform("history", step), ","))


@query("life_cycle", "cert_no:str state:str since:str become_old:str history:str", f"""
WITH r AS (SELECT l.*, s, e, newest, {gap_sql('e', TODAY)} AS ended,
  CASE WHEN state = '4' AND {gap_sql('e', TODAY)} > 180 THEN 1
       WHEN state = '1' AND {gap_sql('e', TODAY)} > 60 THEN 2
       WHEN state = '3' AND {gap_sql('e', TODAY)} > 60 THEN 3
       WHEN state = '2' AND {TODAY} BETWEEN s AND e AND {gap_sql('s', 'e')} >= 30 AND {gap_sql(TODAY, 'e')} <= 60 THEN 4
       WHEN state = '2' AND {TODAY} BETWEEN s AND e AND {gap_sql('s', 'e')} < 30 AND {gap_sql(TODAY, 'newest')} < 30 THEN 5
       WHEN state = '2' AND NOT ({TODAY} BETWEEN s AND e) AND {gap_sql('e', TODAY)} > 30 THEN 6
       WHEN state = '1' AND become_old <= {TODAY} AND {gap_sql('e', 'become_old')} <= 60 THEN 7 ELSE 0 END AS rule
  FROM x_labels l JOIN x_span sp ON sp.cert_no = l.cert_no WHERE l.cert_no NOT IN (SELECT cert_no FROM x_new_holder))
SELECT cert_no, [state, '5', '4', '4', '3', '3', '3', '2'][rule + 1] AS state,
  CASE rule WHEN 0 THEN since WHEN 1 THEN e + 180 WHEN 2 THEN e + 60 WHEN 3 THEN e + 60 WHEN 4 THEN {TODAY} WHEN 5 THEN {TODAY}
    WHEN 6 THEN CASE WHEN e >= since THEN e + 30 ELSE since + 1 END ELSE become_old END AS since, become_old,
  '0:' || CASE WHEN rule IN (1, 3, 4, 5, 6) THEN ',' || state || ':' || CAST(since AS VARCHAR) ELSE '' END AS history FROM r""")
def life_cycle(t: Tables) -> DataFrame:
    stored = labels(t).join(new_holders(t), "cert_no", "left_anti")
    return history_text(L.life_cycle(stored, L.policy_span(holders(t)), AS_OF))


@query("life_cycle_return", "cert_no:str state:str since:str history:str redeemed:str redeem_days:long awakened:str awaken_days:long", f"""
SELECT n.cert_no, CASE WHEN state IS NULL OR state = '0' THEN '1' WHEN state IN ('3', '4', '5') THEN '2' ELSE state END AS state,
  CASE WHEN state IN ('1', '2') THEN since ELSE {TODAY} END AS since,
  CASE WHEN state IS NULL THEN '1:' || CAST({TODAY} AS VARCHAR) WHEN state = '0' THEN '0:,0:' WHEN state IN ('3', '4', '5') THEN '0:,' || state || ':' || CAST(since AS VARCHAR)
    ELSE '0:' END AS history,
  CASE WHEN state IN ('3', '4') THEN '是' END AS redeemed, CASE WHEN state IN ('3', '4') THEN {gap_sql('since', TODAY)} END AS redeem_days,
  CASE WHEN state = '5' THEN '是' END AS awakened, CASE WHEN state = '5' THEN {gap_sql('since', TODAY)} END AS awaken_days
FROM (SELECT DISTINCT cert_no FROM x_holder WHERE start_date >= DATE '{NEW_SINCE}' UNION SELECT slave_cert_no FROM d_dependant) n
LEFT JOIN x_labels l ON l.cert_no = n.cert_no""")
def life_cycle_return(t: Tables) -> DataFrame:
    """Holders since the cut, and the dependants as people who became holders without being known before."""
    arrived = new_holders(t).unionByName(t.dependant.select(F.col("slave_cert_no").alias("cert_no")).distinct())
    return history_text(L.life_cycle_return(labels(t), arrived, AS_OF))


@query("life_cycle_new_insured", "cert_no:str state:str", f"""
SELECT i.cert_no, coalesce(state, '0') AS state FROM (SELECT DISTINCT cert_no FROM d_insured WHERE start_date >= DATE '{NEW_SINCE}') i
LEFT JOIN x_labels l ON l.cert_no = i.cert_no WHERE i.cert_no NOT IN (SELECT cert_no FROM x_new_holder)""")
def life_cycle_new_insured(t: Tables) -> DataFrame:
    covered = t.insured.where(F.col("start_date") >= F.lit(NEW_SINCE))
    return L.new_insured(labels(t), covered, new_holders(t))


_FILLED = ["name", "gender", "birthday", "age", "decade", "age_band", "retired", "home_code", "star_sign", "home_province", "home_city", "phones", "sport", "children"]


@query("label_fill_rate", "label:str filled:long total:long", "\nUNION ALL ".join(
    f"SELECT '{c}' AS label, count({c}) AS filled, count(*) AS total FROM x_profile" for c in _FILLED))
def label_fill_rate(t: Tables) -> DataFrame:
    return Q.fill_rate(profile(t).select("cert_no", *_FILLED), "cert_no")


CTES["x_edges"] = """
SELECT DISTINCT src, dst, via FROM (
  SELECT h.cert_no AS src, i.cert_no AS dst, CAST(h.policy_id AS VARCHAR) AS via FROM x_holder h JOIN d_insured i ON i.policy_id = h.policy_id
  UNION ALL SELECT i.cert_no, s.slave_cert_no, s.master_id FROM d_insured i JOIN d_dependant s ON s.master_id = i.insured_id)"""


@query("insurance_graph", "src:str dst:str via:str", "SELECT * FROM x_edges")
def insurance_graph(t: Tables) -> DataFrame:
    return P.insurance_graph(holders(t), t.insured, t.dependant)[1]


@query("insurance_graph_vertices", "cert_no:str", """
SELECT cert_no FROM x_holder UNION SELECT cert_no FROM d_insured UNION SELECT slave_cert_no FROM d_dependant""")
def insurance_graph_vertices(t: Tables) -> DataFrame:
    return P.insurance_graph(holders(t), t.insured, t.dependant)[0]


