from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from coverlake.operators import premium as P

D = date.fromisoformat
POLICY = "policy_id int, start_date date, end_date date, charge_type int, price decimal(14,4)"
INSURED = "insured_id int, policy_id int, cert_no string, start_date date, end_date date"


def policy(rows):
    return rows(POLICY, [
        (1, D("2020-01-01"), D("2020-01-10"), P.ANNUAL, Decimal("100.0000")),
        (2, D("2020-01-01"), D("2020-01-03"), P.MONTHLY, Decimal("100.0000")),
        (3, D("2020-01-01"), D("2020-01-02"), P.ANNUAL, Decimal("1.0000")),
    ])


def insured(rows):
    return rows(INSURED, [
        (1, 1, "x", D("2019-12-30"), D("2020-01-02")),   # begins before the policy
        (2, 1, "x", D("2020-01-02"), D("2020-01-20")),   # same person again, ends after the policy
        (3, 1, "y", D("2020-01-04"), None),              # no end: one day
        (4, 1, "z", D("2020-02-01"), D("2020-02-05")),   # outside
        (5, 2, "x", D("2020-01-01"), D("2020-01-03")),   # 100 / 3 is not divisible
        (6, 2, "y", D("2020-01-05"), D("2020-01-01")),   # start after end
    ])


def cover(rows):
    return P.clamped_cover(insured(rows), policy(rows))


def test_cover_is_cut_to_the_policy(rows):
    got = {r.insured_id: (r.cover_start, r.cover_end) for r in cover(rows).collect()}
    assert got == {
        1: (D("2020-01-01"), D("2020-01-02")), 2: (D("2020-01-02"), D("2020-01-10")),
        3: (D("2020-01-04"), D("2020-01-04")), 5: (D("2020-01-01"), D("2020-01-03")),
    }


def test_day_price_divides_by_policy_days_or_own_days(rows):
    got = {r.insured_id: r.day_price for r in P.day_prices(cover(rows)).collect()}
    assert got == {1: Decimal("10.0000"), 2: Decimal("10.0000"), 3: Decimal("10.0000"), 5: Decimal("33.3333")}


def test_daily_premium_two_ways(rows):
    runs = {(r.policy_id, r.day): r.premium for r in P.daily_premium(cover(rows)).collect()}
    plain = {(r.policy_id, r.day): r.premium for r in P.daily_premium_exploded(cover(rows)).collect()}
    assert runs == plain
    assert runs[(1, D("2020-01-02"))] == Decimal("20.0000")


def test_headcount_counts_a_person_once_and_knows_empty_days(rows):
    from coverlake.operators.timeline import explode_days

    days = explode_days(P.daily_headcount_runs(cover(rows), policy(rows)), "from_day", "to_day")
    got = {(r.policy_id, r.day.day): r.head_count for r in days.collect()}
    assert [got[(1, d)] for d in range(1, 11)] == [1, 1, 1, 2, 1, 1, 1, 1, 1, 1]
    assert [got[(3, d)] for d in (1, 2)] == [0, 0]
    assert len(got) == 15


def test_headcount_sum_is_exposure(rows):
    from coverlake.operators.timeline import explode_days

    c = cover(rows)
    days = explode_days(P.daily_headcount_runs(c, policy(rows)), "from_day", "to_day").groupBy("policy_id").agg(F.sum("head_count").alias("n"))
    exposure = {r.policy_id: r.person_count for r in P.exposure_to_date(c, D("2021-01-01")).collect()}
    assert {r.policy_id: r.n for r in days.where("n > 0").collect()} == exposure


def test_earned_stops_before_today(rows):
    got = {r.policy_id: r.earned_premium for r in P.earned_to_date(cover(rows), policy(rows), D("2020-01-03")).collect()}
    assert got == {1: Decimal("30.0000"), 2: Decimal("66.6666"), 3: Decimal("0.0000")}


def test_ledger_branches(rows):
    policies = rows("policy_id int, policy_status int, predecessor string, first_premium decimal(14,4), person_count int, start_date date", [
        (1, 1, None, None, None, D("2020-01-01")),           # new, no premium known
        (2, -1, "P1", Decimal("5"), 3, D("2020-01-01")),     # renewed, cancelled later
        (3, 0, "", Decimal("5"), 3, D("2020-01-01")),        # neither
        (4, 99, None, Decimal("5"), 3, D("2020-01-01")),     # unknown status
    ])
    changes = rows("preserve_id string, policy_id int, preserve_type int, preserve_status int, add_premium decimal(14,4), del_premium decimal(14,4), "
                   "add_person_count int, del_person_count int, effective_date date", [
        ("a", 1, 1, 1, Decimal("9"), Decimal("-2"), 3, 1, D("2020-02-01")),
        ("b", 1, 1, 0, Decimal("9"), None, 3, 1, D("2020-02-01")),           # not in effect
        ("c", 1, 3, 0, None, Decimal("-4"), None, 2, D("2020-02-01")),       # cancelled counts in any status
        ("d", 9, 1, 1, Decimal("9"), None, 3, 1, D("2020-02-01")),           # no such policy
    ])
    got = {(r.policy_id, r.preserve_id, r.premium_type, r.sum_premium, r.sum_person) for r in P.premium_ledger(policies, changes).collect()}
    assert got == {(1, None, 4, Decimal("0"), 0), (2, "P1", 2, Decimal("5"), 3), (1, "a", 1, Decimal("7"), 2), (1, "c", 3, Decimal("-4"), -2)}
