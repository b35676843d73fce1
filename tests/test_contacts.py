from datetime import date

from coverlake.operators.profile import person_contacts

SCHEMA = "cert_no string, mobile string, start date, end date, source string"
ONE, TWO = "110101199001011234", "11010119900101123X"


def test_positions_run_newest_first_and_by_text_within_a_day(rows):
    day = lambda n: date(2024, 3, n)
    data = [
        (ONE, "b", day(2), None, "web"), (ONE, "a", day(2), None, "web"), (ONE, "c", day(9), None, "inter"), (ONE, "b", day(1), None, "web"),
        (ONE, "d", None, day(1), "web"), (ONE, "e", None, None, "web"), (ONE, None, day(9), None, "other"),
        (TWO, None, day(4), None, "other"), ("110101", "x", day(4), None, "web"),
    ]
    got = {(r.cert_no, r.mobile, r.latest, r.position, r.sources) for r in person_contacts(rows(SCHEMA, data)).collect()}
    known = "inter:other:web"
    assert got == {
        (ONE, "c", day(9), 1, known), (ONE, "a", day(2), 2, known), (ONE, "b", day(2), 3, known), (ONE, "d", day(1), 4, known),
        (TWO, None, None, None, "other"),
    }


def test_no_contact(rows):
    assert person_contacts(rows(SCHEMA, [])).collect() == []
