"""History of a keyed table from its changes: validity intervals, the state at any moment, and gaps in the feed.

Changes may arrive in any order and more than once; only ``seq`` orders them. Changes of a key are ranged by time
(``period`` of ``seq.ts``). A range orders its own changes; what crosses a range is one row: its first change, its last
one, and the first change of the life that is open at its end. So a key that holds a large share of all changes spreads over
as many tasks as it has periods, and no sort holds more of it than one.

A version is the whole change with the interval in which it is the latest, so a history can be folded again with changes
that come late: see :func:`extend`. Its before-image ``old`` is a list of (key, value), as maps can be neither compared nor hashed.

Defined cases: repeated changes of one ``seq`` count once, of differing ones the largest; a change without a key is left out;
one without a time comes before all others; no changes give an empty history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Milliseconds of ``seq.ts`` ordered together: a day.
PERIOD = 86_400_000
#: What a version has beside its key and the columns of its table.
MARKS = ("seq", "type", "until", "starts", "life", "before", "old")
ENTRIES = "array<struct<key: string, value: string>>"
_DELETE = "DELETE"


def _columns(versions: DataFrame, key: str) -> list[str]:
    return [c for c in versions.columns if c != key and c not in MARKS]


def _with_entries(changes: DataFrame) -> DataFrame:
    if "old" not in changes.columns:
        changes = changes.withColumn("old", F.lit(None).cast(ENTRIES))
    if isinstance(changes.schema["old"].dataType, T.MapType):
        changes = changes.withColumn("old", F.array_sort(F.map_entries("old")).cast(ENTRIES))
    return changes


def history(changes: DataFrame, key: str, period: int = PERIOD) -> DataFrame:
    """One row per change of (``key``, ``seq``, ``type``, ``old``, columns) with the time it is the latest one of its key.

    Added are ``until`` (``seq`` of the next change, null while it is the latest), ``starts`` (it begins a life: the first change
    of the key or the first after a delete), ``life`` (the columns as that first change had them) and ``before`` (type and columns
    of the change before it, null if there is none). ``old``, a map or its entries, may be missing.
    """
    changes = _with_entries(changes)
    columns = _columns(changes, key)
    row = F.struct("type", *columns, "old")
    once = (
        changes.where(F.col(key).isNotNull())
        .withColumn("_range", F.coalesce(F.expr(f"seq.ts div {int(period)}"), F.lit(-(1 << 62))))
        .groupBy(key, "_range", "seq")
        .agg(F.max(row).alias("row"))
        .select(key, "_range", "seq", "row.*")
    )
    image = F.struct(*columns)
    whole = F.struct("type", image.alias("image"))
    inside = Window.partitionBy(key, "_range").orderBy("seq")
    ordered = once.withColumns({"until": F.lead("seq").over(inside), "before": F.lag(whole).over(inside)})
    alive = F.col("type") != _DELETE
    begins = alive & (F.col("before.type") == _DELETE)  # known inside the range; its first change is settled by the range before

    first = F.min_by(F.struct("seq", "type", image.alias("image")), "seq").alias("head")
    last = F.max_by(whole, "seq").alias("tail")
    opened = F.max_by(F.when(begins, image), F.when(begins, F.col("seq"))).alias("opened")
    ranges = ordered.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_at")).agg(first, last, opened)
    by_range = Window.partitionBy("_key").orderBy("_at")
    carried = ranges.select(
        "_key", "_at", "head", "opened", F.lag("tail").over(by_range).alias("_before"), F.lead("head.seq").over(by_range).alias("_until")
    )
    fresh = (F.col("head.type") != _DELETE) & F.coalesce(F.col("_before.type") == _DELETE, F.lit(True))
    opening = F.coalesce("opened", F.when(fresh, F.col("head.image")))
    carried = carried.select("_key", "_at", "_before", "_until", F.last(opening, True).over(by_range.rowsBetween(Window.unboundedPreceding, -1)).alias("_life"))

    both = ordered.join(carried, (F.col(key) == F.col("_key")) & (F.col("_range") == F.col("_at")))
    linked = both.withColumns({"until": F.coalesce("until", "_until"), "before": F.coalesce("before", "_before")})
    starts = alive & F.coalesce(F.col("before.type") == _DELETE, F.lit(True))
    own = F.last(F.when(F.col("starts"), image), True).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return linked.withColumn("starts", starts).select(
        key, "seq", "type", "old", *columns, "until", "starts", F.when(alive, F.coalesce(own, "_life")).alias("life"), "before"
    )


def changes_of(versions: DataFrame, key: str) -> DataFrame:
    """The changes a history was made of."""
    return versions.select(key, "seq", "type", "old", *_columns(versions, key))


def extend(stored: DataFrame, fresh: DataFrame, key: str, period: int = PERIOD) -> DataFrame:
    """A stored history with further changes, late and repeated ones too.

    Only keys that changed are folded again; the others pass by. The join is on the distinct keys of ``fresh``.
    """
    touched = fresh.where(F.col(key).isNotNull()).select(key).distinct()
    old = changes_of(stored.join(touched, key, "left_semi"), key)
    again = history(old.unionByName(_with_entries(fresh), allowMissingColumns=True), key, period)
    return stored.join(touched, key, "left_anti").unionByName(again)


def valid_at(versions: DataFrame, key: str, update: Sequence[str], ts: Column, beside: Sequence[str] = ()) -> DataFrame:
    """State right after all changes up to and at ``ts``: what a fold of those changes gives, as (key, seq, columns).

    ``ts`` may be a column, and columns ``beside`` those of the table are kept: states of many moments from one history.
    ``update`` columns are those of the version, the others those its life began with. Changes without a time count always.
    """
    after = F.col("seq.ts") > ts
    gone = F.col("until").isNotNull() & (F.col("until.ts").isNull() | (F.col("until.ts") <= ts))
    held = versions.where((F.col("type") != _DELETE) & ~F.coalesce(after, F.lit(False)) & ~gone)
    own = [c for c in _columns(versions, key) if c not in beside]
    return held.select(*beside, key, "seq", *[(F.col(c) if c in update else F.col(f"life.{c}")).alias(c) for c in own])


def gaps(versions: DataFrame, key: str) -> DataFrame:
    """Where the feed cannot be whole, as (key, ``seq``, ``reason``, ``columns``).

    ``insert``: an insert of a row that is there. ``missing``: an update or a delete of a row that is not there. ``before``: a
    before-image that differs from the version before it, with the names of the ``columns`` that differ, in order. A value of
    a before-image is read as its column's type; values that cannot be read as it are left alone, like names of no column.
    """
    there = F.coalesce(F.col("before.type") != _DELETE, F.lit(False))
    columns = _columns(versions, key)
    differing = []
    for c in sorted(columns):
        kind = versions.schema[c].dataType
        given, known = F.col("_old")[c], F.col(f"before.image.{c}")
        value = given if isinstance(kind, T.StringType) else given.try_cast(kind)
        readable = given.isNull() | value.isNotNull()
        # a column that is not in the before-image did not change
        differing.append(F.when(F.map_contains_key("_old", c) & readable & ~value.eqNullSafe(known), F.lit(c)))
    names = F.array_compact(F.array(*differing)) if differing else F.array().cast("array<string>")
    checked = F.when((F.col("type") == "UPDATE") & there, names)
    reason = (
        F.when((F.col("type") == "INSERT") & there, "insert")
        .when((F.col("type") != "INSERT") & ~there, "missing")
        .when(F.size("_names") > 0, "before")
    )
    marked = versions.withColumn("_old", F.map_from_entries("old")).withColumn("_names", checked).withColumn("_reason", reason)
    return marked.where("_reason is not null").select(
        key, "seq", F.col("_reason").alias("reason"), F.when(F.col("_reason") == "before", F.col("_names")).alias("columns")
    )
