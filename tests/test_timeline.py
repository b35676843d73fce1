from datetime import date, timedelta

from pyspark.sql import functions as F

from coverlake.operators import timeline as T

D = date.fromisoformat
COVER = "k string, p string, s date, e date, v int"


def cover(rows):
    return rows(COVER, [
        ("a", "x", D("2020-01-01"), D("2020-01-05"), 1),
        ("a", "x", D("2020-01-04"), D("2020-01-09"), 2),   # overlaps
        ("a", "x", D("2020-01-10"), D("2020-01-10"), 3),   # touches, one day
        ("a", "y", D("2020-01-20"), D("2020-01-18"), 4),   # start after end
        ("b", "x", D("2020-02-28"), D("2020-03-01"), 5),   # 29 February inside
    ])


def test_days_include_both_ends_and_skip_inverted_ranges(rows):
    days = T.explode_days(cover(rows), "s", "e")
    assert days.where("v = 3").count() == 1
    assert days.where("v = 4").count() == 0
    assert [r.day for r in days.where("v = 5").orderBy("day").collect()] == [D("2020-02-28"), D("2020-02-29"), D("2020-03-01")]


def test_months_touch_both_ends(rows):
    df = rows("s date, e date", [(D("2019-12-31"), D("2020-02-01")), (D("2020-02-01"), D("2020-01-31"))])
    assert [r.month for r in T.explode_months(df, "s", "e").orderBy("month").collect()] == [D("2019-12-01"), D("2020-01-01"), D("2020-02-01")]


def test_levels_equal_exploded_sums(rows):
    df = cover(rows)
    plain = {(r.k, r.day): r.v for r in T.explode_days(df, "s", "e").groupBy("k", "day").agg(F.sum("v").alias("v")).collect()}
    runs = T.explode_days(T.levels(df, ["k"], "s", "e", {"v": F.col("v")}), "from_day", "to_day")
    assert {(r.k, r.day): r.v for r in runs.collect()} == plain


def test_merged_intervals_are_disjoint(rows):
    merged = {(r.k, r.p, r.start, r.end) for r in T.merge_intervals(cover(rows), ["k", "p"], "s", "e").collect()}
    assert merged == {("a", "x", D("2020-01-01"), D("2020-01-10")), ("b", "x", D("2020-02-28"), D("2020-03-01"))}


def test_sums_inside_equals_a_range_join(rows):
    start = D("2020-01-01")
    covers = [("a", start + timedelta(d), start + timedelta(d + n)) for d in (0, 3, 7) for n in (-1, 0, 4, 9)]
    facts = [("a", start + timedelta(d), d + 1) for d in (0, 0, 3, 7, 11, 16, 20)] + [("a", None, 100), ("b", start, 1)]
    got = {
        (r.s, r.e): r.v
        for r in T.sums_inside(rows("k string, s date, e date", covers), rows("k string, d date, v int", facts), ["k"], "s", "e", "d", ["v"]).collect()
    }
    want = {(s, e): sum(v for k, d, v in facts if k == "a" and (d is None or s <= d <= e)) for _, s, e in covers}
    assert got == want


def test_previous_in_time_breaks_ties_on_the_id(rows):
    df = rows("k string, d date, id int", [("a", D("2020-01-01"), 5), ("a", D("2020-01-01"), 7), ("a", D("2020-01-03"), 1), ("b", D("2020-01-01"), 2)])
    got = {r.id: r.before for r in T.previous_in_time(df, "k", "d", "id", "before").collect()}
    assert got == {5: None, 7: 5, 1: 7, 2: None}


def test_previous_in_time_keeps_every_row(rows):
    many = [("a", D("2020-01-02"), 3 * k) for k in range(9000)]
    data = [("a", None, 4), ("a", None, 9), (None, D("2020-01-01"), 1), (None, None, 2), ("a", D("2020-01-01"), 5), *many]
    got = {(r.k, r.d, r.id): r.before for r in T.previous_in_time(rows("k string, d date, id int", data), "k", "d", "id", "before").collect()}
    assert len(got) == len(data)
    assert got["a", None, 4] is None and got["a", None, 9] == 4 and got["a", D("2020-01-01"), 5] == 9
    assert got[None, D("2020-01-01"), 1] is None and got[None, None, 2] is None
    assert got["a", D("2020-01-02"), 0] == 5 and all(got["a", D("2020-01-02"), 3 * k] == 3 * k - 3 for k in range(1, 9000))
    text = rows("k string, d date, id string", [("a", D("2020-01-01"), i) for i in ("ab", "abcdefgh1", "ac", "abcdefgh", "b")])
    assert {r.id: r.before for r in T.previous_in_time(text, "k", "d", "id", "before").collect()} == {
        "ab": None, "abcdefgh": "ab", "abcdefgh1": "abcdefgh", "ac": "abcdefgh1", "b": "ac"}


def test_calendar_labels(spark):
    day = T.calendar(spark, D("2020-02-28"), D("2020-03-02")).where("c_day_id = '20200229'").first()
    assert (day.week_day, day.c_month_id, day.c_month_end_date, day.c_ten_day_id, day.c_quarter_id, day.d_last_month_day) == (
        6, "202002", D("2020-02-29"), "2020-T06", "2020-Q1", D("2020-01-29"))


def test_prefix_sums_equal_a_running_sum(rows):
    start = D("2019-12-28")
    data = [(k, start + timedelta(d) if d is not None else None, v) for k in ("a", None) for d, v in [(None, 1), (0, 2), (0, 3), (6, 5), (7, 7), (40, 11), (-30, 13)]]
    df = rows("k string, d date, v int", data)
    for period in (1, 7, 1000):
        got = sorted(((r.k, r.d, r.v) for r in T.prefix_sums(df, ["k"], "d", ["v"], period).collect()), key=str)
        want = [(k, d, sum(w for l, e, w in data if l == k and (e is None or (d is not None and e <= d)))) for k, d, _ in data]
        assert got == sorted(want, key=str), period


def test_one_key_with_most_rows_spreads_over_the_tasks(spark):
    """90 % of the rows are of one key: no task of the window reads more than twice the median."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        df = spark.range(60_000).select(
            F.when(F.col("id") % 10 > 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.date_add(F.lit(D("2015-01-01")), (F.col("id") % 3001).cast("int")).alias("d"), F.lit(1).alias("v")
        )
        done = T.prefix_sums(df, ["k"], "d", ["v"])
        sizes = sorted(r["count"] for r in done.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert len(sizes) == 4 and sizes[-1] <= 2 * sizes[2]
        assert done.where("k = -1").agg(F.max("v")).first()[0] == 54_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_covers_of_one_person_and_facts_without_a_key_or_day(rows):
    covers = [(k, D("2020-01-01") + timedelta(d), D("2020-01-01") + timedelta(d + 20)) for k in ("a", None) for d in range(60)]
    facts = [(k, D("2020-01-01") + timedelta(d), 1) for k in ("a", None) for d in range(0, 90, 3)] + [("a", None, 50), (None, None, 70)]
    got = T.sums_inside(rows("k string, s date, e date", covers), rows("k string, d date, v int", facts), ["k"], "s", "e", "d", ["v"]).collect()
    want = {(k, s, e): sum(v for l, d, v in facts if l == k and (d is None or s <= d <= e)) for k, s, e in covers}
    assert {(r.k, r.s, r.e): r.v for r in got} == want
