from datetime import date, timedelta

import pytest

from coverlake.operators import lifecycle as L

NOW = date(2021, 6, 30)
LABEL = "cert_no string, state string, since date, become_old date, history array<struct<state:string,since:date>>"
SPAN = "cert_no string, start date, end date, newest date"


def ago(days):
    return NOW - timedelta(days)


@pytest.mark.parametrize("state, since, old, start, end, newest, want, want_since, logged", [
    ("4", ago(100), ago(900), ago(600), ago(181), ago(600), "5", ago(1), True),        # asleep after 180 days
    ("4", ago(100), ago(900), ago(600), ago(180), ago(600), "4", ago(100), False),
    ("1", ago(100), ago(10), ago(160), ago(61), ago(160), "4", ago(1), False),         # a new customer is lost without a trace
    ("3", ago(100), ago(900), ago(600), ago(61), ago(600), "4", ago(1), True),
    ("2", ago(100), ago(900), ago(300), NOW + timedelta(60), ago(300), "3", NOW, True),   # long cover about to end
    ("2", ago(100), ago(900), ago(300), NOW + timedelta(61), ago(300), "2", ago(100), False),
    ("2", ago(100), ago(900), ago(10), NOW + timedelta(10), ago(10), "3", NOW, True),     # short cover, nothing new
    ("2", ago(100), ago(900), ago(10), NOW + timedelta(10), NOW + timedelta(40), "2", ago(100), False),
    ("2", ago(100), ago(900), ago(300), ago(31), ago(300), "3", ago(1), True),            # out of cover, end after the state began
    ("2", ago(20), ago(900), ago(300), ago(31), ago(300), "3", ago(19), True),            # ... or before it
    ("2", ago(100), ago(900), ago(300), ago(30), ago(300), "2", ago(100), False),
    ("1", ago(100), ago(5), ago(100), NOW + timedelta(200), ago(100), "2", ago(5), False),  # 90 days are over
    ("1", ago(100), NOW + timedelta(5), ago(85), NOW + timedelta(200), ago(85), "1", ago(100), False),
    ("0", None, ago(5), ago(85), NOW, ago(85), "0", None, False),
])
def test_each_rule(rows, state, since, old, start, end, newest, want, want_since, logged):
    labels, span = rows(LABEL, [("x", state, since, old, [])]), rows(SPAN, [("x", start, end, newest)])
    got = L.life_cycle(labels, span, NOW).first()
    assert (got.state, got.since) == (want, want_since)
    assert [(h.state, h.since) for h in got.history] == ([(state, since)] if logged else [])


def test_newest_start_is_not_before_the_last_ending_policy(rows):
    policies = rows("cert_no string, policy_id int, start_date date, end_date date", [("x", 1, ago(10), ago(1)), ("x", 2, ago(50), NOW), ("x", 3, ago(40), NOW)])
    got = L.policy_span(policies).first()
    assert (got.start, got.end, got.newest) == (ago(40), NOW, ago(10))


def test_return(rows):
    labels = rows(LABEL, [("p", "0", None, None, None), ("o", "2", ago(9), None, []), ("l", "4", ago(9), None, []), ("s", "5", ago(7), None, [])])
    arrived = rows("cert_no string", [("p",), ("o",), ("l",), ("s",), ("u",), ("u",)])
    got = {r.cert_no: r for r in L.life_cycle_return(labels, arrived, NOW).collect()}
    assert {k: r.state for k, r in got.items()} == {"p": "1", "o": "2", "l": "2", "s": "2", "u": "1"}
    assert (got["l"].redeemed, got["l"].redeem_days, got["l"].awakened) == ("是", 9, None)
    assert (got["s"].awakened, got["s"].awaken_days, got["s"].redeemed) == ("是", 7, None)
    assert (got["o"].since, list(got["o"].history)) == (ago(9), [])
    assert [(h.state, h.since) for h in got["u"].history] == [("1", NOW)]
    assert [(h.state, h.since) for h in got["p"].history] == [("0", None)]
