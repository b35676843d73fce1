from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from coverlake.operators import premium as P
from coverlake.operators import risk as R

D = date.fromisoformat
MONEY = "decimal(14,4)"


def tables(rows):
    policy = rows(
        f"policy_id long, channel string, insurer string, charge_type int, start_date date, end_date date, price {MONEY}",
        [(1, "c", "i", 1, D("2005-01-01"), D("2005-01-10"), Decimal(10)), (2, "c", "i", 1, D("2005-01-05"), None, Decimal(3)),
         (3, "d", None, 2, D("2004-01-01"), D("2005-12-31"), Decimal(7310)), (4, None, "i", 1, D("2005-01-01"), D("2005-01-02"), Decimal(1)),
         (5, "e", "i", 1, D("2006-01-01"), D("2006-01-02"), Decimal(1))],
    )
    insured = rows(
        "policy_id long, cert_no string, start_date date, end_date date",
        [(1, "a", D("2005-01-01"), D("2005-01-10")), (1, "a", D("2005-01-04"), D("2005-01-06")), (1, "b", D("2005-01-08"), None), (1, None, D("2005-01-01"), D("2005-01-02")),
         (2, "a", D("2005-01-05"), D("2005-01-05")), (3, "z", D("2003-01-01"), D("2007-01-01")), (3, "z", D("2004-03-01"), D("2004-04-01")), (5, "q", D("2006-01-01"), D("2006-01-02"))],
    )
    ledger = rows(f"policy_id long, day date, sum_premium {MONEY}", [(1, D("2005-01-01"), Decimal(5)), (1, D("2005-02-01"), Decimal(9)), (3, D("2005-06-01"), Decimal(-2)), (3, None, Decimal(1))])
    claim = rows(
        f"policy_id long, risk_day date, payable {MONEY}, case_status string",
        [(1, D("2005-01-03"), Decimal(7), R.SETTLED), (1, D("2005-03-03"), Decimal(100), R.SETTLED), (3, D("2004-05-05"), Decimal(4), "open"), (3, None, Decimal(50), "open"), (3, D("2005-01-02"), None, R.SETTLED)],
    )
    return policy, insured, ledger, claim


def test_labels_and_claims_have_no_last_year(rows):
    policy, insured, _, claim = tables(rows)
    cover = P.clamped_cover(insured, policy, carry=("channel",))
    got = {(r.channel, r.ten_day): (r.month, float(r.earned), r.payable) for r in R.target_months(cover, claim, "channel").collect()}
    month, earned, payable = got["c", "2005-T01"]
    assert month == "200501" and payable == Decimal(7) and earned > 10


def test_totals_of_one_day_equal_the_monitor_of_that_day(rows):
    policy, insured, ledger, claim = tables(rows)
    cover = P.clamped_cover(insured, policy, carry=("channel", "insurer"))
    for day in ("2004-01-01", "2005-01-05", "2005-01-10", "2005-06-30", "2006-01-01"):
        as_of = D(day)
        today = R.risk_monitor_today(policy, P.clamped_cover(insured, policy), ledger, claim, as_of)
        whole = R.risk_monitor(policy, cover, ledger, claim, as_of).where(F.col("day") == F.lit(as_of))
        columns = sorted(today.columns)
        assert sorted(map(str, today.select(columns).collect())) == sorted(map(str, whole.select(*[F.col(c).cast(today.schema[c].dataType) for c in columns]).collect())), day
