from datetime import date
from decimal import Decimal

from coverlake.operators import claims as C

D = date.fromisoformat


def test_payable_falls_back_to_the_reserve(rows):
    raw = rows("case_no string, policy_id int, person_id int, risk_cert_no string, case_status string, case_type string, risk_date string, "
               "final_payment string, pre_com string", [
        ("a", 1, 1, "x", "结案", "死亡", "2020/02/29", "5.5", "9"), ("b", 1, 1, "x", "结案", "死亡", "2020-01-02", "", "9"),
        ("c", 1, 1, "x", "结案", "死亡", "", "NULL", "9"), ("d", 1, 1, "x", "结案", "死亡", "2020", None, None)])
    got = {r.case_no: (r.risk_day, r.payable) for r in C.claim_conform(raw).collect()}
    assert got == {"a": (D("2020-02-29"), Decimal("5.5")), "b": (D("2020-01-02"), Decimal(9)), "c": (None, Decimal(9)), "d": (None, None)}


def test_claim_on_first_and_last_day_and_without_date(rows):
    insured = rows("policy_id int, cert_no string, start_date date, end_date date", [
        (1, "x", D("2020-01-01"), D("2020-01-31")), (1, "x", D("2020-03-01"), None), (1, "x", None, D("2020-05-01")), (2, "x", D("2020-01-01"), D("2020-01-31"))])
    claim = rows("policy_id int, risk_cert_no string, risk_day date, payable decimal(14,4)", [
        (1, "x", D("2020-01-01"), Decimal(1)), (1, "x", D("2020-01-31"), Decimal(2)), (1, "x", D("2020-02-01"), Decimal(4)), (1, "x", None, Decimal(8)),
        (1, "x", D("2020-03-01"), Decimal(16))])
    got = {(r.policy_id, r.start_date): r.claim_payable for r in C.claims_in_cover(insured, claim).collect()}
    assert got == {(1, D("2020-01-01")): Decimal(11), (1, D("2020-03-01")): Decimal(8)}


def test_grades(rows):
    grades = rows("policy_id int, profession_type string", [(1, "1-3类"), (2, "5类"), (3, ""), (4, None), (5, "4类")])
    got = {r.policy_id: (r.grade_low, r.grade_high) for r in C.grade_bounds(grades).collect()}
    assert got == {1: (1, 3), 2: (1, 5), 3: (-1, -1), 4: (-1, -1), 5: (1, 4)}


def test_standard_risk_reads_the_part_before_the_bar(rows):
    risk = rows("standard_work_name string, standard_work_risk string, gs_work_risk string", [
        ("a", "3", "12|3"), ("a", "2", "S|1"), ("b", "1", ""), ("c", "1", None)])
    got = {r.work_name_check: (r.work_risk, r.gs_work_risk) for r in C.standard_risk(risk).collect()}
    assert got == {"a": ("2", 0), "b": ("1", -1)}


def test_claims_without_a_policy_meet_covers_without_one(rows):
    insured = rows(
        "policy_id long, cert_no string, start_date date, end_date date",
        [(None, "a", D("2001-01-01"), D("2001-01-31")), (1, "a", D("2001-01-01"), D("2001-01-31")), (1, "a", D("2001-01-01"), D("2001-01-31")), (1, "b", D("2001-01-01"), D("2001-01-31")),
         (2, "b", D("2001-01-01"), None), (None, "c", D("2001-01-01"), None), (3, None, D("2001-01-01"), None)],
    )
    claim = rows(
        "policy_id long, risk_cert_no string, risk_day date, payable decimal(14,4)",
        [(None, "a", D("2001-01-05"), Decimal(3)), (1, "a", D("2001-01-31"), Decimal(5)), (2, "b", None, Decimal(7)), (2, "a", None, Decimal(9)), (3, None, None, Decimal(1))],
    )
    got = {(r.policy_id, r.cert_no): (r.claim_payable, r.claim_cases) for r in C.claims_in_cover(insured, claim).collect()}
    assert got == {(None, "a"): (Decimal(3), 1), (1, "a"): (Decimal(10), 2), (2, "b"): (Decimal(7), 1)}
