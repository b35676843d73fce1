"""Day-level building blocks.

Most of them first shrink a group to at most one row per calendar day (a partial aggregate, done before the shuffle), and
only then use a window. Such a window partition is bounded by the length of the calendar, whatever share of the input one
key holds. The exceptions say so.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from coverlake.functions.dates import day_id, month_id, ten_day_label

#: Neighbouring ids sorted together by :func:`previous_in_time`.
BUCKET, PREFIX = 1 << 12, 8
#: Days summed together by :func:`prefix_sums`.
PERIOD = 7


def shared(df: DataFrame, key: str) -> DataFrame:
    """The same rows behind a shuffle that Spark keeps, so plans that use ``df`` more than once compute it once.

    Spark reuses equal shuffles, not the joins above them, and drops a shuffle by a key its input is dealt by already; a hash
    of the key is another one. For results far smaller than what they are made from.
    """
    return df.repartition(F.xxhash64(key))


def day_range(start: Column, end: Column) -> Column:
    """All days from start to end, both included; empty if start is after end."""
    return F.when(start <= end, F.sequence(start, end))


def explode_days(df: DataFrame, start: str, end: str, day: str = "day") -> DataFrame:
    """One row per day of [start, end]; a row whose start is after its end disappears."""
    return df.withColumn(day, F.explode(day_range(F.col(start), F.col(end))))


def explode_months(df: DataFrame, start: str, end: str, month: str = "month") -> DataFrame:
    """One row per calendar month touched by [start, end], given as the first day of the month."""
    first, last = F.trunc(F.col(start), "month"), F.trunc(F.col(end), "month")
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    return df.withColumn(month, F.explode(months))


def deltas(df: DataFrame, keys: Sequence[str], start: str, end: str, measures: dict[str, Column]) -> DataFrame:
    """What each interval adds on its first day and takes back after its last, from one pass over the intervals.

    Returns keys, ``day``, ``active`` (plus or minus one) and the measures.
    """
    first = F.struct(F.col(start).alias("day"), F.lit(1).alias("active"), *[c.alias(m) for m, c in measures.items()])
    after = F.struct(F.date_add(F.col(end), 1).alias("day"), F.lit(-1).alias("active"), *[(-c).alias(m) for m, c in measures.items()])
    return df.where(F.col(start) <= F.col(end)).select(*keys, F.inline(F.array(first, after)))


def runs(changes: DataFrame, keys: Sequence[str], names: Sequence[str], flows: Sequence[str] = ()) -> DataFrame:
    """Levels between the days on which something changes.

    ``changes`` has keys, ``day``, ``active``, the named measures and flows. Returns keys, ``from_day``, ``to_day``,
    ``active`` (open intervals), the running sums of the measures, and each flow as it fell on ``from_day``. Days without an
    open interval give no row.
    """
    levelled = ["active", *names]
    per_day = changes.groupBy(*keys, "day").agg(*[F.sum(m).alias(m) for m in [*levelled, *flows]])
    by_day = Window.partitionBy(*keys).orderBy("day")
    running = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.select(
        *keys,
        F.col("day").alias("from_day"),
        F.date_sub(F.lead("day").over(by_day), 1).alias("to_day"),
        *[F.sum(m).over(running).alias(m) for m in levelled],
        *flows,
    ).where(F.col("active") > 0)


def levels(df: DataFrame, keys: Sequence[str], start: str, end: str, measures: dict[str, Column]) -> DataFrame:
    """Sum of ``measures`` over the intervals open on each day, as runs of days with one level.

    Equal to exploding each interval into days and summing by (keys, day), at two rows per interval instead of one per
    day.
    """
    return runs(deltas(df, keys, start, end, measures), keys, list(measures))


def merge_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Union of overlapping or touching day intervals per key: keys, ``start``, ``end``, disjoint."""
    furthest = (
        df.where(F.col(start) <= F.col(end))
        .groupBy(*keys, F.col(start).alias("start"))
        .agg(F.max(F.col(end)).alias("end"))
    )
    by_start = Window.partitionBy(*keys).orderBy("start")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") <= F.date_add("reach", 1), 0).otherwise(1)).over(
        by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        furthest.withColumn("reach", reach)
        .withColumn("island", island)
        .groupBy(*keys, "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .drop("island")
    )


def prefix_sums(rows: DataFrame, keys: Sequence[str], day: str, measures: Sequence[str], period: int = PERIOD) -> DataFrame:
    """Each measure summed over the rows of the same keys up to and on the row's day, in two passes.

    Rows are ranged by (keys, ``period`` days). The first pass sums each range, which is a partial aggregate, and adds the
    sums up over the ranges of a key, at most one row per period of the calendar. The second pass puts what came before a
    range in front of its rows and sums inside the range. So one key spreads over as many tasks as it has periods, and no
    sort holds more of it than one. A null day comes before all others. Null keys are a key of their own.
    """
    own = [c for c in rows.columns if c not in measures]
    at = F.coalesce(F.expr(f"unix_date(`{day}`) div {int(period)}"), F.lit(-(1 << 31)))
    ranged = rows.withColumn("_range", at)
    kinds = {m: f"decimal(38,{t.scale})" if isinstance(t := rows.schema[m].dataType, DecimalType) else t.simpleString() for m in measures}
    summed = ranged.groupBy(*keys, "_range").agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in measures])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = summed.select(*keys, "_range", *[F.sum(m).over(earlier).cast(kinds[m]).alias(m) for m in measures], F.lit(0).alias("_row"))
    inside = Window.partitionBy(*keys, "_range").orderBy("_row", day)  # default RANGE frame: rows of one day share one value
    both = ranged.withColumn("_row", F.lit(1)).withColumns({m: F.col(m).cast(k) for m, k in kinds.items()})
    return (
        both.unionByName(carried, allowMissingColumns=True)
        .select(*own, "_row", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).cast(kinds[m]).alias(m) for m in measures])
        .where("_row = 1")
        .drop("_row")
    )


def sums_inside(
    covers: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    fact_day: str,
    measures: Sequence[str],
) -> DataFrame:
    """For each cover (keys, start, end): sum of the measures of facts with the same keys dated inside it.

    An interval join without pairs and without a join of intervals: facts shrink to one row per (keys, day), their prefix
    sums are read at ``end`` and just before ``start``, and the two readings are subtracted. Facts without a date count in
    every cover of their keys: they come before all days, so sums of their own have them at every reading. A cover without a
    fact gives zero. ``covers`` must be
    distinct; further columns of it are kept. Covers and facts of one key spread over the periods of :func:`prefix_sums`.
    """
    s, e, day = F.col(start), F.col(end), F.col(fact_day)
    own = covers.columns
    kinds = {m: facts.schema[m].dataType for m in measures}
    undated = {m: f"_undated_{m}" for m in measures}
    daily = facts.groupBy(*keys, day.alias("day")).agg(
        *[F.sum(F.when(day.isNotNull(), F.col(m))).cast(kinds[m]).alias(m) for m in measures],
        *[F.sum(F.when(day.isNull(), F.col(m))).alias(u) for m, u in undated.items()],
    )
    kinds |= {u: daily.schema[u].dataType for u in undated.values()}
    readings = covers.select(
        *own,
        F.inline(
            F.array(
                F.struct(F.when(s <= e, e).otherwise(s).alias("day"), F.lit(1).alias("sign")),
                F.struct(F.when(s <= e, F.date_sub(s, 1)).otherwise(s).alias("day"), F.lit(-1).alias("sign")),
            )
        ),
        *[F.lit(0).cast(t).alias(m) for m, t in kinds.items()],
    )
    return (
        prefix_sums(daily.unionByName(readings, allowMissingColumns=True), keys, "day", list(kinds))
        .where(F.col("sign").isNotNull())
        .groupBy(*own)
        .agg(*[(F.sum(F.col(m) * F.col("sign")) + F.sum(F.when(F.col("sign") > 0, F.col(u)))).alias(m) for m, u in undated.items()])
    )


def previous_in_time(df: DataFrame, key: str, day: str, tiebreak: str, out: str) -> DataFrame:
    """``lag(tiebreak)`` per key ordered by (day, tiebreak), a null day first; every row stays. A row without a key has
    nothing before it.

    Ids of one key and day are sorted in buckets of ``BUCKET`` neighbouring ids (text ids: those of one prefix), and what
    crosses a bucket is its largest id. So a key with very many rows on one day costs a sort per bucket and one row for
    each, not a sort of all of them.
    """
    whole = isinstance(df.schema[tiebreak].dataType, IntegralType)
    bucket = F.floor(F.col(tiebreak) / BUCKET) if whole else F.substring(tiebreak, 1, PREFIX)
    cut = df.withColumn("_bucket", bucket)
    inner = Window.partitionBy(key, day, "_bucket").orderBy(tiebreak)
    across = Window.partitionBy("_key").orderBy("_day", "_last")
    last = (
        cut.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.col(day).alias("_day"), F.col("_bucket").alias("_of"))
        .agg(F.max(tiebreak).alias("_last"))
        .select("_key", "_day", "_of", F.lag("_last").over(across).alias("_carried"))
    )
    same = (F.col(key) == F.col("_key")) & F.col(day).eqNullSafe(F.col("_day")) & F.col("_bucket").eqNullSafe(F.col("_of"))
    before = F.when(F.col(key).isNotNull(), F.lag(tiebreak).over(inner))
    return (
        cut.withColumn("_same", before)
        .join(last, same, "left")
        .withColumn(out, F.coalesce("_same", "_carried"))
        .drop("_same", "_carried", "_bucket", "_key", "_day", "_of")
    )


def day_labels(d: Column) -> dict[str, Column]:
    """Week, ten-day, month and quarter labels of a day, for any day there is."""
    year = F.year(d).cast("string")
    return {
        "c_day_id": day_id(d),
        "c_week_id": F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lpad(F.weekofyear(d).cast("string"), 2, "0")),
        "week_day": F.weekday(d) + 1,
        "c_month_id": month_id(d),
        "c_month_end_date": F.last_day(d),
        "c_ten_day_id": F.concat(year, F.lit("-T"), F.lpad(((F.month(d) - 1) * 3 + ten_day_label(d)).cast("string"), 2, "0")),
        "c_quarter_id": F.concat(year, F.lit("-Q"), F.quarter(d).cast("string")),
        "d_last_month_day": F.add_months(d, -1),
    }


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Day dimension with all labels, one row per day from start to end."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("d_day"))
    return days.select("d_day", *[c.alias(n) for n, c in day_labels(F.col("d_day")).items()])
