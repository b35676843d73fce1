"""Deltas, keyed merges and change logs.

None of these sorts a key's rows: the latest or first change of a key is a partial aggregate, so a key that holds a large
share of the changes is reduced before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlake.functions.text import md5_trimmed

INSERTED, UPDATED = 0, 1


def snapshot_delta(today: DataFrame, yesterday: DataFrame, key: str, version: str) -> DataFrame:
    """Rows that are new (0) or whose version changed (1) since yesterday's (key, version). Deletes are not seen."""
    old = yesterday.select(F.col(key), F.col(version).alias("old_version"), F.lit(True).alias("known"))
    kind = F.when(F.col("known").isNull(), INSERTED).when(~F.col("old_version").eqNullSafe(F.col(version)), UPDATED)
    return today.join(old, key, "left").withColumn("inc_type", kind).where("inc_type is not null").drop("old_version", "known")


def keyed_merge(stored: DataFrame, new: DataFrame, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """Insert or replace by key. Of several new rows of one key the one with the largest ``version`` counts (of equals,
    and without a version, the one with the largest values)."""
    rest = [c for c in new.columns if c not in keys]
    order = F.struct(*[c for c in [version] if c], *[c for c in rest if c != version])
    folded = new.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("row")).select(*keys, "row.*") if rest else new.distinct()
    kept = stored.join(folded.select(*keys), list(keys), "left_anti")
    return kept.unionByName(folded)


def label_merge(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Merge labels by key; an empty or null new label never overwrites a stored one."""
    labels = [c for c in stored.columns if c != key]
    fresh = [c for c in new.columns if c != key and c not in labels]

    def filled(c: str) -> Column:
        value = F.col(f"n.{c}")
        return F.when(F.length(value.cast("string")) > 0, value)

    both = stored.alias("s").join(new.alias("n"), F.col(f"s.{key}") == F.col(f"n.{key}"), "full")
    merged = [
        (F.coalesce(filled(c), F.col(f"s.{c}")) if c in new.columns else F.col(f"s.{c}")).alias(c) for c in labels
    ]
    return both.select(F.coalesce(f"n.{key}", f"s.{key}").alias(key), *merged, *[filled(c).alias(c) for c in fresh])


def fold_changes(changes: DataFrame, key: str, update: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """State of a keyed table after a change log of (key, seq, type, columns).

    After the last delete of a key, its first change sets every column and its last one the ``update`` columns. The order
    is ``seq``, not arrival, so late or repeated changes never win. Keys whose last change is a delete are gone.
    """
    fixed = [c for c in changes.columns if c not in (key, "seq", "type", *update, *keep)]
    gone = changes.where(F.col("type") == "DELETE").groupBy(key).agg(F.max("seq").alias("deleted_at"))
    alive = (
        changes.where(F.col("type") != "DELETE")
        .join(gone, key, "left")
        .where(F.col("deleted_at").isNull() | (F.col("seq") > F.col("deleted_at")))
    )
    first = F.min_by(F.struct(F.col("seq"), *fixed), "seq")
    last = F.max_by(F.struct(F.col("seq"), *update), "seq")
    return (
        alive.groupBy(key)
        .agg(first.alias("first"), last.alias("last"))
        .select(key, F.col("last.seq").alias("seq"), *[F.col(f"first.{c}").alias(c) for c in fixed], *[F.col(f"last.{c}").alias(c) for c in update])
    )


def pair_anti_join(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys, null counted as a value, are not stored yet."""
    match = None
    for k in keys:
        same = F.col(f"r.{k}").eqNullSafe(F.col(f"k.{k}"))
        match = same if match is None else match & same
    return rows.alias("r").join(stored.select(*keys).alias("k"), match, "left_anti")


def pii_vault(rows: DataFrame, stored: DataFrame, as_of: Column) -> DataFrame:
    """Md5 of certificate and phone with the month of the first known date, for pairs not stored yet.

    ``rows`` has cert_no, mobile, business_line and the dates start, end, created, updated.
    """
    known = rows.where(F.col("cert_no").isNotNull() | F.col("mobile").isNotNull())
    month = F.date_format(F.coalesce("start", "end", "created", "updated", as_of), "yyyy-MM")
    fresh = pair_anti_join(known, stored, ["cert_no", "mobile", "business_line"])
    return fresh.select(
        "cert_no",
        "mobile",
        "business_line",
        month.alias("month"),
        md5_trimmed(F.col("cert_no")).alias("cert_md5"),
        md5_trimmed(F.col("mobile")).alias("mobile_md5"),
    ).distinct()


def new_people(rows: DataFrame, stored_ids: DataFrame, as_of: Column, look_back: int = 15) -> DataFrame:
    """Person rows created in the look-back window (no creation time counts as now) whose id is not stored yet."""
    recent = rows.where(F.coalesce(F.col("created"), as_of) >= F.date_sub(as_of, look_back))
    return recent.join(stored_ids, ["policy_id", "business_line"], "left_anti").withColumn(
        "month", F.date_format(F.coalesce("start", "end", "created", as_of), "yyyy-MM")
    )


def shard_union(shards: Sequence[DataFrame], key: str, version: str) -> DataFrame:
    """Archived and current shards as one table, one row per key: the newest version."""
    whole = shards[0]
    for shard in shards[1:]:
        whole = whole.unionByName(shard)
    rest = [c for c in whole.columns if c != key]
    return whole.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(version, *[c for c in rest if c != version])).alias("row")).select(key, "row.*")
