"""Change-data-capture: parse envelopes, keep a change log per table, read the current state.

The log is partitioned by micro-batch and a batch overwrites only its own partition, so a replayed batch changes nothing
and the cost of a batch follows its size, not the size of the table. State is a fold over the log by sequence number;
:func:`compact` shortens a log to the changes that still matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlake.operators.incremental import fold_changes
from coverlake.streaming.tables import ReplicatedTable

ENVELOPE = T.StructType(
    [
        T.StructField("data", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField("database", T.StringType()),
        T.StructField("pkNames", T.ArrayType(T.StringType())),
        T.StructField("table", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("old", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    ]
)
CHANGE_TYPES = ["INSERT", "UPDATE", "DELETE"]
#: Names a change has of its own; a table's column of such a name carries a mark until the state is read.
RESERVED = ("type", "reason", "raw", "batch_id", "old", "until", "starts", "life", "before")


def column(name: str) -> str:
    """Name of a table's column among its changes."""
    return f"{name}_" if name in RESERVED else name


def classified(messages: DataFrame, table: ReplicatedTable, value: str = "value") -> DataFrame:
    """Typed rows of one table from JSON envelopes, each with ``reason`` and the ``raw`` text where something is wrong.

    Routing looks at the parsed table and type, never at the raw text, and every row of a message counts. ``seq`` is the
    envelope's timestamp, then the row's place in the message. ``reason`` is ``text`` for what is no envelope, ``key`` for a
    row whose key is missing or cannot be read, ``value`` for one with another value that cannot (that value is null).
    """
    m, row = F.col("m"), F.col("row")
    parsed = messages.select(F.col(value).alias("raw"), F.from_json(F.col(value), ENVELOPE).alias("m"))
    unreadable = m.isNull() | m["table"].isNull() | m["type"].isNull()
    mine = (m["table"] == table.name) & m["type"].isin(CHANGE_TYPES)
    rows = parsed.where(unreadable | mine).select(
        "raw", unreadable.alias("unreadable"), m["type"].alias("type"), m["ts"].alias("ts"), F.posexplode_outer(m["data"]).alias("place", "row")
    )
    typed = {c: row[c].try_cast(kind) for c, kind in table.columns.items()}
    lost = F.lit(False)
    for c in typed:
        lost = lost | (row[c].isNotNull() & typed[c].isNull())
    reason = F.when(F.col("unreadable"), "text").when(typed[table.key].isNull(), "key").when(lost, "value")
    return rows.select(
        F.struct(F.col("ts").alias("ts"), F.col("place").cast("long").alias("place")).alias("seq"),
        "type",
        *[c.alias(column(n)) for n, c in typed.items()],
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.col("raw")).alias("raw"),
    )


def usable(rows: DataFrame) -> DataFrame:
    """The changes among classified rows."""
    return rows.where(F.col("reason").isNull() | (F.col("reason") == "value")).drop("reason", "raw")


def parse_envelope(messages: DataFrame, table: ReplicatedTable, value: str = "value") -> DataFrame:
    """Typed change rows of one table from JSON envelopes."""
    return usable(classified(messages, table, value))


def apply_changes(changes: DataFrame, table: ReplicatedTable) -> DataFrame:
    """Current rows of a replicated table."""
    folded = fold_changes(changes, table.key, [column(c) for c in table.update if c != table.key])
    return folded.withColumnsRenamed({column(c): c for c in table.columns if c in RESERVED})


def kafka_messages(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Message texts of a topic from the newest offset on; later starts go on from the checkpoint."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def append_changes(changes: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch into its own partition of the log. A replay overwrites the same partition."""
    changes.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("batch_id").parquet(f"{path}/changes")


def start(messages: DataFrame, table: ReplicatedTable, path: str, checkpoint: str, once: bool = False):
    """Start the stream of one table. A batch is evaluated and written once; one that fails is replayed from the checkpoint.

    Messages and rows that cannot be read go to the same log with their raw text, see :func:`rejects`.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        append_changes(batch, batch_id, path)

    rows = classified(messages, table)
    messages.sparkSession.createDataFrame([], rows.schema).withColumn("batch_id", F.lit(0)).write.mode("ignore").partitionBy("batch_id").parquet(f"{path}/changes")
    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="2 seconds")).start()


def current(spark: SparkSession, table: ReplicatedTable, path: str) -> DataFrame:
    """The table as of the last complete batch; empty before the first."""
    return apply_changes(usable(_log(spark, table, path)), table)


def rejects(spark: SparkSession, table: ReplicatedTable, path: str) -> DataFrame:
    """What could not be read, wholly or in part: batch, reason and raw text."""
    return _log(spark, table, path).where("reason is not null").select("batch_id", "reason", "raw")


def _log(spark: SparkSession, table: ReplicatedTable, path: str) -> DataFrame:
    columns = ", ".join(f"`{column(c)}` {kind}" for c, kind in table.columns.items())
    schema = f"seq struct<ts: bigint, place: bigint>, type string, {columns}, reason string, raw string, batch_id int"
    return spark.read.schema(schema).parquet(f"{path}/changes")


def compact(changes: DataFrame, table: ReplicatedTable) -> DataFrame:
    """The changes of a log that can still matter: per key its last delete, the first change after it and the last one.

    Written to a new log, it stands in for the old batches as long as later changes carry higher sequence numbers.
    """
    key = table.key
    row = F.struct(*[c for c in changes.columns if c != key])
    gone = changes.where(F.col("type") == "DELETE").groupBy(key).agg(F.max_by(row, "seq").alias("gone"))
    alive = (
        changes.where(F.col("type") != "DELETE")
        .join(gone, key, "left")
        .where(F.col("gone").isNull() | (F.col("seq") > F.col("gone.seq")))
        .groupBy(key)
        .agg(F.min_by(row, "seq").alias("first"), F.max_by(row, "seq").alias("last"))
    )
    kept = alive.select(key, F.inline(F.array_distinct(F.array("first", "last"))))
    return kept.unionByName(gone.select(key, "gone.*"))
