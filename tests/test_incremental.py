from datetime import date

from pyspark.sql import functions as F

from coverlake.operators import incremental as I

LOG = "key int, seq int, type string, v int, fixed string"


def state(df):
    return {r.key: (r.seq, r.v, r.fixed) for r in df.collect()}


def test_fold_keeps_first_fixed_and_last_updated_value(rows):
    log = rows(LOG, [
        (1, 1, "INSERT", 1, "a"), (1, 3, "UPDATE", 3, "c"), (1, 2, "UPDATE", 2, "b"),   # out of order
        (2, 1, "DELETE", None, None), (2, 2, "INSERT", 5, "x"),                        # delete before insert
        (3, 1, "INSERT", 1, "a"), (3, 2, "DELETE", None, None),                        # gone
        (4, 5, "DELETE", None, None), (4, 4, "INSERT", 1, "late"),                     # a late insert does not revive
        (5, 1, "INSERT", 1, "a"), (5, 2, "DELETE", None, None), (5, 3, "UPDATE", 9, "z"),
    ])
    assert state(I.fold_changes(log, "key", ["v"])) == {1: (3, 3, "a"), 2: (2, 5, "x"), 5: (3, 9, "z")}


def test_snapshot_delta(rows):
    today = rows("id int, u date", [(1, date(2020, 1, 1)), (2, date(2020, 1, 2)), (3, date(2020, 1, 1)), (4, None)])
    old = rows("id int, u date", [(1, date(2020, 1, 1)), (2, date(2020, 1, 1)), (4, date(2020, 1, 1)), (9, date(2020, 1, 1))])
    assert {(r.id, r.inc_type) for r in I.snapshot_delta(today, old, "id", "u").collect()} == {(2, 1), (3, 0), (4, 1)}


def test_labels_are_never_overwritten_by_nothing(rows):
    stored = rows("id int, a string, b string", [(1, "x", "y"), (2, "p", None)])
    new = rows("id int, a string, c string", [(1, "", "n"), (2, "q", None), (3, "r", "s")])
    got = {r.id: (r.a, r.b, r.c) for r in I.label_merge(stored, new, "id").collect()}
    assert got == {1: ("x", "y", "n"), 2: ("q", None, None), 3: ("r", None, "s")}


def test_pairs_with_one_null_are_compared_as_pairs(rows):
    seen = rows("cert_no string, mobile string, business_line string", [("a", "1", "o"), ("b", None, "o"), (None, "2", "o")])
    new = rows("cert_no string, mobile string, business_line string", [
        ("a", "1", "o"), ("a", None, "o"), ("b", None, "o"), (None, "2", "o"), (None, "1", "o"), ("a", "1", "p")])
    left = {tuple(r) for r in I.pair_anti_join(new, seen, ["cert_no", "mobile", "business_line"]).collect()}
    assert left == {("a", None, "o"), (None, "1", "o"), ("a", "1", "p")}


def test_shards_keep_the_newest_version(rows):
    a, b = rows("id int, version int, x string", [(1, 1, "old"), (2, 1, "only")]), rows("id int, version int, x string", [(1, 2, "new")])
    assert {r.id: r.x for r in I.shard_union([a, b], "id", "version").collect()} == {1: "new", 2: "only"}


def test_keyed_merge(rows):
    a, b = rows("id int, x string", [(1, "a"), (2, "b")]), rows("id int, x string", [(2, "c"), (3, "d")])
    assert {r.id: r.x for r in I.keyed_merge(a, b, ["id"]).collect()} == {1: "a", 2: "c", 3: "d"}
    assert I.keyed_merge(a, b.where(F.lit(False)), ["id"]).count() == 2
