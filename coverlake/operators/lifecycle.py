"""Customer life-cycle: 0 potential, 1 new, 2 old, 3 easy to lose, 4 lost, 5 asleep."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.functions.dates import day_gap

POTENTIAL, NEW, OLD, EASY_TO_LOSE, LOST, ASLEEP = "0", "1", "2", "3", "4", "5"


def policy_span(policy: DataFrame) -> DataFrame:
    """Per holder: start and end of the policy that ends last, and the newest start, which is never before that start."""
    return (
        policy.where(F.col("end_date").isNotNull())
        .groupBy("cert_no")
        .agg(F.max_by(F.struct("start_date", "end_date"), F.struct("end_date", "policy_id")).alias("p"), F.max("start_date").alias("newest"))
        .select(
            "cert_no",
            F.col("p.start_date").alias("start"),
            F.col("p.end_date").alias("end"),
            F.greatest("newest", "p.start_date").alias("newest"),
        )
    )


def life_cycle(labels: DataFrame, span: DataFrame, as_of: date) -> DataFrame:
    """One step of the life-cycle for stored labels (cert_no, state, since, become_old, history).

    A row starts in one state and the rules of different states exclude each other, so one ladder holds them all; the
    order of its rungs is the order of evaluation. Every step but those out of state 1 is added to the history.
    """
    now = F.lit(as_of)
    start, end, newest = F.col("start"), F.col("end"), F.col("newest")
    state, since = F.col("state"), F.col("since")
    ended = day_gap(end, now)
    inside = now.between(start, end)
    long_cover = day_gap(start, end) >= 30
    rungs = [
        ((state == LOST) & (ended > 180), ASLEEP, F.date_add(end, 180)),
        (state.isin(NEW, EASY_TO_LOSE) & (ended > 60), LOST, F.date_add(end, 60)),
        ((state == OLD) & inside & long_cover & (day_gap(now, end) <= 60), EASY_TO_LOSE, now),
        ((state == OLD) & inside & ~long_cover & (day_gap(now, newest) < 30), EASY_TO_LOSE, now),
        (
            (state == OLD) & start.isNotNull() & end.isNotNull() & ~inside & (ended > 30),
            EASY_TO_LOSE,
            F.when(end >= since, F.date_add(end, 30)).otherwise(F.date_add(since, 1)),
        ),
        ((state == NEW) & (F.col("become_old") <= now) & (day_gap(end, F.col("become_old")) <= 60), OLD, F.col("become_old")),
    ]
    next_state, next_since, moved = state, since, F.lit(False)
    for condition, to, when in reversed(rungs):
        next_state = F.when(condition, F.lit(to)).otherwise(next_state)
        next_since = F.when(condition, when).otherwise(next_since)
        moved = F.when(condition, F.lit(True)).otherwise(moved)
    step = F.array(F.struct(state.alias("state"), since.alias("since")))
    return labels.join(span, "cert_no").select(
        "cert_no",
        next_state.alias("state"),
        next_since.alias("since"),
        "become_old",
        F.when(moved & (state != NEW), F.concat("history", step)).otherwise(F.col("history")).alias("history"),
    )


def life_cycle_return(labels: DataFrame, new_holders: DataFrame, as_of: date) -> DataFrame:
    """What a new policy does to its holder's state; unknown holders become new customers."""
    now = F.lit(as_of)
    state, since = F.col("state"), F.col("since")
    back, woken = state.isin(EASY_TO_LOSE, LOST), state == ASLEEP
    none = F.lit(None).cast("date")
    step = F.array(F.struct(state.alias("state"), F.when(state == POTENTIAL, none).otherwise(since).alias("since")))
    first = F.array(F.struct(F.lit(NEW).alias("state"), now.alias("since")))
    empty = F.coalesce("history", F.array().cast(labels.schema["history"].dataType))
    changed = state.isNull() | (state == POTENTIAL) | back | woken
    return (
        new_holders.select("cert_no")
        .distinct()
        .join(labels, "cert_no", "left")
        .select(
            "cert_no",
            F.when(state.isNull() | (state == POTENTIAL), NEW).when(back | woken, OLD).otherwise(state).alias("state"),
            F.when(changed, now).otherwise(since).alias("since"),
            F.when(state.isNull(), first).when(changed, F.concat(empty, step)).otherwise(F.col("history")).alias("history"),
            F.when(back, "是").alias("redeemed"),
            F.when(back, day_gap(since, now)).alias("redeem_days"),
            F.when(woken, "是").alias("awakened"),
            F.when(woken, day_gap(since, now)).alias("awaken_days"),
        )
    )


def new_insured(labels: DataFrame, covered: DataFrame, new_holders: DataFrame) -> DataFrame:
    """State of newly insured people who are no holders: unknown ones are potential customers."""
    people = covered.select("cert_no").distinct().join(new_holders.select("cert_no"), "cert_no", "left_anti")
    return people.join(labels, "cert_no", "left").select("cert_no", F.coalesce("state", F.lit(POTENTIAL)).alias("state"))
