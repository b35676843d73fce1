from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from coverlake.functions import certificate as C
from coverlake.functions import dates as D
from coverlake.functions import text as X


def one(spark, column, **values):
    """The value of a column expression over one literal row."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize("value, want", [("", None), (" ", None), ("NULL", None), ("null", None), (None, None), (" a b ", "ab")])
def test_clean(spark, value, want):
    assert one(spark, X.clean(F.col("c")), c=value) == want


def test_text(spark):
    assert one(spark, X.drop_empty(F.col("c")), c="") is None
    assert one(spark, X.drop_empty(F.col("c")), c="null") == "null"
    assert one(spark, X.md5_trimmed(F.col("c")), c=" a ") == "0cc175b9c0f1b6a831c399e269772661"
    assert one(spark, X.md5_trimmed(F.col("c").cast("string")), c=None) is None
    assert one(spark, X.mask_name(F.col("c")), c="abcde") == X.MASK + "cde"
    assert one(spark, X.mask_name(F.col("c")), c="abc") == X.MASK + "bc"
    assert one(spark, X.mask_name(F.col("c")), c="a") == "a"
    assert one(spark, X.chinese_only(F.col("c")), c="a装1配") == "装配"
    assert one(spark, X.chinese_only(F.col("c").cast("string")), c=None) == "null"
    assert one(spark, X.default_int(F.col("c")), c="") == 9


@pytest.mark.parametrize("cert, want", [
    ("110101199001011234", True), ("11010119900101123X", True), ("11010119900101123x", True), ("110101199001011", False), ("1101011990010112*4", False), (None, False)])
def test_full_certificate(spark, cert, want):
    assert one(spark, C.is_full(F.col("c").cast("string")), c=cert) is want


@pytest.mark.parametrize("cert, when, want", [
    ("110101199006151234", date(2020, 6, 14), 30),   # the birthday is not reached
    ("110101199006151234", date(2020, 6, 15), 31),   # nominal age: one more from the birthday on
    ("110101202006151234", date(2020, 6, 15), 1),
    ("110101202006161234", date(2020, 6, 15), 0),
    ("110101203006151234", date(2020, 6, 15), 0),    # born later
    ("110101191806151234", date(2020, 6, 15), 0),    # before 1919
    ("110101199013151234", date(2020, 6, 15), 0),    # no such month
    ("110101199006151", date(2020, 6, 15), 0),       # 15 digits
    ("110101199006151234", None, 0),
])
def test_nominal_age(spark, cert, when, want):
    assert one(spark, C.age_at(F.col("c"), F.col("w").cast("date")), c=cert, w=when) == want


@pytest.mark.parametrize("month, day, want", [(1, 19, 10), (1, 20, 11), (12, 21, 9), (12, 22, 10), (3, 20, 12), (3, 21, 1)])
def test_star_sign(spark, month, day, want):
    assert one(spark, C.star_sign(F.col("m"), F.col("d")), m=month, d=day) == want


def test_no_star(spark):
    assert one(spark, C.has_no_star(F.col("c").cast("string")), c=None) is True
    assert one(spark, C.has_no_star(F.col("c")), c="1*") is False


@pytest.mark.parametrize("end, want", [(date(2020, 1, 1), 1), (date(2020, 1, 2), 1), (date(2020, 1, 3), 2), (date(2019, 12, 30), -2)])
def test_day_gap(spark, end, want):
    assert one(spark, D.day_gap(F.col("s"), F.col("e")), s=date(2020, 1, 1), e=end) == want


@pytest.mark.parametrize("hour, want", [(0, "23-1时"), (1, "1-3时"), (2, "1-3时"), (5, "5-7时"), (22, "21-23时"), (23, "23-1时")])
def test_ride_bucket(spark, hour, want):
    assert one(spark, D.ride_bucket(F.col("h")), h=hour) == want


def test_dates(spark):
    assert one(spark, D.text_date(F.col("c")), c="2020/02/29") == date(2020, 2, 29)
    assert one(spark, D.text_date(F.col("c")), c="2020") is None
    assert one(spark, D.text_timestamp(F.col("c")), c="2020-01-01 10:00:00.0") == "2020-01-01 10:00:00"
    assert one(spark, D.text_timestamp(F.col("c")), c="2020-01-01") is None
    assert one(spark, D.weekday_monday_first(F.col("d")), d=date(2020, 3, 1)) == 7
    assert one(spark, D.month_end(F.col("d")), d=date(2020, 2, 1)) == datetime(2020, 2, 29, 23, 59, 59)
    assert one(spark, D.shift_months(F.col("d"), 1), d=date(2020, 1, 31)) == date(2020, 2, 29)
    assert one(spark, D.shift_hours(F.col("d"), 2), d=datetime(2020, 1, 1, 23)) == datetime(2020, 1, 2, 1)
    assert one(spark, D.whole_months_to(F.col("d"), F.lit(date(2020, 3, 30))), d=date(2020, 1, 31)) == 1
    assert one(spark, D.latest(F.col("a").cast("date"), F.col("b")), a=None, b=date(2020, 1, 1)) == date(2020, 1, 1)
    assert one(spark, D.ten_day_label(F.col("d")), d=date(2020, 1, 31)) == 3
