"""Several replicated tables from one stream of messages, parsed once, with one commit for all of them.

A micro-batch is parsed once and written in one pass to a log partitioned by table and batch; then one file commits the
batch. Readers look at committed batches only, so a failure between two tables shows nothing of the batch, and its replay
writes the same partitions again. Values stay text in this log and are typed where a table is read.

:func:`compact` publishes, per table, the changes that still matter as the next version of a versioned table and says up to
which batch it goes. A reader takes a version and the batches after it; :func:`clean` drops batches and versions that no
version needs and no reader holds. So the number of files follows the tables, not the number of batches. As with
:func:`cdc.compact`, a delete that arrives after a compaction with a lower sequence number than changes before it may leave
a column that is set once with the value of a later change: compact no further than changes arrive in order.

:func:`keep_history` publishes all changes of a table with the time each was valid, as versions too; late changes fold only
their own keys again. Once a history is kept, :func:`clean` leaves the batches that it does not include yet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlake.sources.versions import Folder, VersionedTable
from coverlake.streaming import cdc, history
from coverlake.streaming.tables import ReplicatedTable

#: The partition of messages that are no envelope.
UNREADABLE = "_unreadable"
_LOG = "ts bigint, place bigint, type string, row map<string,string>, old map<string,string>, raw string, table string, batch_id bigint"
BUCKETS = 8


def routed(messages: DataFrame, tables: Iterable[ReplicatedTable], value: str = "value") -> DataFrame:
    """Rows of all tables from JSON envelopes, each parsed once: ``table``, ``ts``, ``place``, ``type``, ``row``, ``old``, ``raw``.

    Messages of other tables and kinds are left out; what is no envelope is kept as text.
    """
    m = F.col("m")
    parsed = messages.select(F.col(value).alias("raw"), F.from_json(F.col(value), cdc.ENVELOPE).alias("m"))
    unreadable = m.isNull() | m["table"].isNull() | m["type"].isNull()
    mine = m["table"].isin([t.name for t in tables]) & m["type"].isin(cdc.CHANGE_TYPES)
    return parsed.where(unreadable | mine).select(
        m["ts"].alias("ts"),
        F.posexplode_outer(m["data"]).alias("place", "row"),
        m["type"].alias("type"),
        "raw",
        F.when(unreadable, UNREADABLE).otherwise(m["table"]).alias("table"),
        m["old"].alias("old"),
    ).withColumns({"place": F.col("place").cast("bigint"), "old": F.get("old", "place")})


def write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """All tables' rows of one micro-batch, in one pass. A replay overwrites the same partitions."""
    rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("table", "batch_id").parquet(f"{path}/log")


def commit(spark: SparkSession, batch_id: int, path: str) -> None:
    Folder(spark, path).write(f"commits/{batch_id:010d}", "")


def start(messages: DataFrame, tables: Iterable[ReplicatedTable], path: str, checkpoint: str, once: bool = False, compact_every: int = 0):
    """Start one stream for all ``tables``; every ``compact_every`` batches the logs are compacted and cleaned."""
    tables = list(tables)

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path)
        commit(batch.sparkSession, batch_id, path)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, tables, path)
            clean(batch.sparkSession, tables, path)

    writer = routed(messages, tables).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="2 seconds")).start()


# -- reading


def _stored(spark: SparkSession, table: ReplicatedTable, path: str) -> VersionedTable:
    return VersionedTable(spark, f"{path}/compacted/{table.name}", [table.key], BUCKETS)


def committed(spark: SparkSession, path: str) -> int:
    """The last committed batch, -1 before the first. A batch starts after the one before it is committed."""
    done = Folder(spark, path).names("commits")
    return int(done[-1]) if done else -1


def _log(spark: SparkSession, name: str, path: str, after: int) -> DataFrame:
    """Committed rows of one table after a batch; other tables' and batches' files are not listed as input."""
    if not Folder(spark, path).names("log"):
        return spark.createDataFrame([], _LOG)
    rows = spark.read.schema(_LOG).parquet(f"{path}/log")
    return rows.where((F.col("table") == name) & (F.col("batch_id") > after) & (F.col("batch_id") <= committed(spark, path)))


def _typed(rows: DataFrame, table: ReplicatedTable) -> DataFrame:
    """Typed changes with ``reason`` and ``raw`` where something cannot be read, as :func:`cdc.classified` has them."""
    row = F.col("row")
    values = {c: row[c].try_cast(kind) for c, kind in table.columns.items()}
    lost = F.lit(False)
    for c, value in values.items():
        lost = lost | (row[c].isNotNull() & value.isNull())
    reason = F.when(values[table.key].isNull(), "key").when(lost, "value")
    return rows.select(
        F.struct("ts", "place").alias("seq"), "type", *[v.alias(cdc.column(c)) for c, v in values.items()], reason.alias("reason"), F.when(reason.isNotNull(), F.col("raw")).alias("raw"), "batch_id", "old"
    )


def changes(spark: SparkSession, table: ReplicatedTable, path: str, version: int | None = None) -> DataFrame:
    """Changes of one table that still matter: a compacted version and the committed batches after it."""
    stored = _stored(spark, table, path)
    found = stored.manifest(version)
    fresh = cdc.usable(_typed(_log(spark, table.name, path, found.note["upto"] if found else -1), table)).drop("batch_id", "old")
    return stored.read(found.version).unionByName(fresh) if found else fresh


def current(spark: SparkSession, table: ReplicatedTable, path: str, version: int | None = None) -> DataFrame:
    """The table as of the last committed batch."""
    return cdc.apply_changes(changes(spark, table, path, version), table)


@contextmanager
def held(spark: SparkSession, table: ReplicatedTable, path: str) -> Iterator[DataFrame]:
    """The current table, whose files stay while it is read."""
    stored = _stored(spark, table, path)
    if stored.manifest() is None:
        yield current(spark, table, path)
        return
    with stored.held() as version:
        yield current(spark, table, path, version)


def rejects(spark: SparkSession, table: ReplicatedTable | None, path: str) -> DataFrame:
    """What could not be read of a table's rows, or, without a table, the messages that are no envelope: batch, reason, raw."""
    name = table.name if table else UNREADABLE
    fresh = _rejected(spark, table, path, -1)
    if name not in [n.removeprefix("table=") for n in Folder(spark, path).names("rejects")]:
        return fresh
    old = spark.read.schema("reason string, raw string, table string, batch_id bigint").parquet(f"{path}/rejects").where(F.col("table") == name)
    return old.select("batch_id", "reason", "raw").unionByName(fresh.join(old.select("batch_id").distinct(), "batch_id", "left_anti"))


def _rejected(spark: SparkSession, table: ReplicatedTable | None, path: str, after: int) -> DataFrame:
    if table is None:
        return _log(spark, UNREADABLE, path, after).select("batch_id", F.lit("text").alias("reason"), "raw")
    return _typed(_log(spark, table.name, path, after), table).where("reason is not null").select("batch_id", "reason", "raw")


# -- history


def _histories(spark: SparkSession, table: ReplicatedTable, path: str) -> VersionedTable:
    return VersionedTable(spark, f"{path}/history/{table.name}", [table.key], BUCKETS)


def keep_history(spark: SparkSession, tables: Iterable[ReplicatedTable], path: str) -> int:
    """Publish the history of every table up to the last committed batch; buckets without a change keep their files."""
    upto = committed(spark, path)
    for table in tables:
        stored = _histories(spark, table, path)
        found = stored.manifest()
        if found and found.note["upto"] >= upto:
            continue
        rows = _log(spark, table.name, path, found.note["upto"] if found else -1).where(F.col("batch_id") <= upto)
        fresh = cdc.usable(_typed(rows, table)).drop("batch_id")
        versions = history.extend(stored.read(found.version), fresh, table.key) if found else history.history(fresh, table.key)
        stored.write(versions, note={"upto": upto})
    return upto


def kept_history(spark: SparkSession, table: ReplicatedTable, path: str) -> DataFrame:
    """All changes of a table as of the last :func:`keep_history`, see :func:`history.history`."""
    return _histories(spark, table, path).read()


def state_at(spark: SparkSession, table: ReplicatedTable, path: str, ts: int) -> DataFrame:
    """The table as it was right after the changes of a moment, from its history."""
    update = [cdc.column(c) for c in table.update]
    held = history.valid_at(kept_history(spark, table, path), table.key, update, F.lit(ts))
    return held.withColumnsRenamed({cdc.column(c): c for c in table.columns if c in cdc.RESERVED})


# -- compacting


def compact(spark: SparkSession, tables: Iterable[ReplicatedTable], path: str) -> int:
    """Publish a version of every table up to the last committed batch. Readers of older versions go on."""
    upto = committed(spark, path)
    tables = list(tables)
    for table in [*tables, None]:
        kept = _rejected(spark, table, path, -1).withColumn("table", F.lit(table.name if table else UNREADABLE))
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("table", "batch_id").parquet(f"{path}/rejects")
    for table in tables:
        whole = changes(spark, table, path)
        _stored(spark, table, path).write(cdc.compact(whole, table).select(*whole.columns), note={"upto": upto})
    return upto


def clean(spark: SparkSession, tables: Iterable[ReplicatedTable], path: str) -> list[int]:
    """Drop versions but the last two and those held, and the batches that all remaining versions include."""
    folder, least = Folder(spark, path), None
    for table in tables:
        stored = _stored(spark, table, path)
        stored.vacuum(keep=2)
        upto = min((stored.manifest(v).note["upto"] for v in stored.versions()), default=-1)
        past = _histories(spark, table, path)
        if past.versions():
            past.vacuum(keep=2)
            upto = min(upto, past.manifest().note["upto"])
        least = upto if least is None else min(least, upto)
    gone = set()
    for part in folder.names("log"):
        for batch in folder.names(f"log/{part}") if part.startswith("table=") else []:
            if batch.startswith("batch_id=") and int(batch.split("=")[1]) <= (-1 if least is None else least):
                folder.remove(f"log/{part}/{batch}")
                gone.add(int(batch.split("=")[1]))
    for done in folder.names("commits")[:-1]:
        if int(done) in gone:
            folder.remove(f"commits/{done}")
    return sorted(gone)
