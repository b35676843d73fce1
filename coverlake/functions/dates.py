"""Calendar arithmetic as native column expressions. ``as_of`` stands wherever a job would read the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_id(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def month_id(c: Column) -> Column:
    return F.date_format(c, "yyyyMM")


def day_gap(start: Column, end: Column) -> Column:
    """Whole days from start to end; a gap of zero counts as one, negative gaps stay negative."""
    gap = F.datediff(end, start)
    return F.when(gap == 0, 1).otherwise(gap)


def latest(*cols: Column) -> Column:
    """Largest of several dates; nulls are ignored, all null gives null."""
    return F.greatest(*cols)


def weekday_monday_first(c: Column) -> Column:
    return F.weekday(c) + 1


def whole_months_to(c: Column, as_of: Column) -> Column:
    return F.floor(F.months_between(as_of, c)).cast("int")


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def month_end(c: Column) -> Column:
    """Last second of the month."""
    return F.last_day(c).cast("timestamp") + F.expr("interval '23:59:59' hour to second")


def shift_days(c: Column, n: int) -> Column:
    return F.date_add(c, n)


def shift_hours(c: Column, n: int) -> Column:
    return c + F.make_dt_interval(hours=F.lit(n))


def shift_months(c: Column, n: int) -> Column:
    return F.add_months(c, n)


def text_timestamp(c: Column) -> Column:
    """The first 19 characters of a text timestamp; shorter text gives null."""
    return F.when(F.length(c) >= 19, F.substring(c, 1, 19))


def text_date(c: Column) -> Column:
    """A date written with ``/`` or ``-``; null unless the text is longer than seven characters."""
    return F.when(F.length(c) > 7, F.to_date(F.substring(F.replace(c, F.lit("/"), F.lit("-")), 1, 10)))


def is_school_age(age: Column) -> Column:
    return age.between(6, 15)


def ride_bucket(hour: Column) -> Column:
    """Two-hour bucket of a riding hour, ``1-3时`` to ``23-1时``."""
    low = (hour - F.pmod(hour + 1, F.lit(2))).cast("int")
    return F.when(
        hour.between(1, 22), F.concat(low.cast("string"), F.lit("-"), (low + 2).cast("string"), F.lit("时"))
    ).otherwise(F.lit("23-1时"))


def ten_day_label(c: Column) -> Column:
    """Which third of the month a day lies in: 1, 2 or 3."""
    return F.least(F.floor((F.dayofmonth(c) - 1) / 10), F.lit(2)).cast("int") + 1
