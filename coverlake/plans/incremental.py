"""Deltas, merges and change logs."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.adapters import AS_OF, Tables
from coverlake.operators import incremental as I
from coverlake.operators import quality as Q
from coverlake.oracle import CTES, TODAY
from coverlake.registry import query
from coverlake.session import shared_dir
from coverlake.sources.versions import changed_rows
from coverlake.streaming import cdc, history
from coverlake.streaming.tables import ReplicatedTable

SNAPSHOT = date(1999, 6, 30)

CTES["x_yesterday"] = f"""
SELECT policy_id, start_date AS updated FROM d_policy WHERE start_date <= DATE '{SNAPSHOT}'"""
CTES["x_today"] = """
SELECT *, CASE WHEN policy_status = 1 THEN end_date ELSE start_date END AS updated FROM d_policy"""
CTES["x_delta"] = """
SELECT t.*, CASE WHEN y.policy_id IS NULL THEN 0 ELSE 1 END AS inc_type
FROM x_today t LEFT JOIN x_yesterday y ON t.policy_id = y.policy_id WHERE y.policy_id IS NULL OR y.updated <> t.updated"""


def today(t: Tables) -> DataFrame:
    return t.policy.withColumn("updated", F.when(F.col("policy_status") == 1, F.col("end_date")).otherwise(F.col("start_date")))


def yesterday(t: Tables) -> DataFrame:
    """What yesterday's snapshot knew: the policies that had started by then."""
    return t.policy.where(F.col("start_date") <= F.lit(SNAPSHOT)).select("policy_id", F.col("start_date").alias("updated"))


def delta(t: Tables) -> DataFrame:
    return I.snapshot_delta(today(t), yesterday(t), "policy_id", "updated")


@query("snapshot_delta", "policy_id:long updated:str inc_type:long holder_name:str", "SELECT * FROM x_delta")
def snapshot_delta(t: Tables) -> DataFrame:
    return delta(t)


CTES["x_known"] = f"""
SELECT policy_id, start_date AS updated, holder_name FROM d_policy WHERE start_date <= DATE '{SNAPSHOT}'"""
CTES["x_left"] = "SELECT policy_id, updated, holder_name FROM x_today WHERE policy_id % 97 <> 0 AND (policy_id % 11 = 0 OR start_date > DATE '2001-01-01')"
CTES["x_kept"] = f"""
SELECT * FROM x_left UNION ALL SELECT * FROM x_known k WHERE policy_id % 97 <> 0 AND NOT EXISTS (SELECT 1 FROM x_left l WHERE l.policy_id = k.policy_id)"""


@query("snapshot_changes", "policy_id:long updated:str holder_name:str inc_type:long", """
SELECT coalesce(t.policy_id, k.policy_id) AS policy_id, coalesce(t.updated, k.updated) AS updated, coalesce(t.holder_name, k.holder_name) AS holder_name,
  CASE WHEN k.policy_id IS NULL THEN 0 WHEN t.policy_id IS NULL THEN 2 ELSE 1 END AS inc_type
FROM x_kept t FULL JOIN x_known k ON t.policy_id = k.policy_id
WHERE k.policy_id IS NULL OR t.policy_id IS NULL OR t.updated IS DISTINCT FROM k.updated OR t.holder_name IS DISTINCT FROM k.holder_name""")
def snapshot_changes(t: Tables) -> DataFrame:
    """Inserted, updated and deleted policies between two snapshots, by the buckets whose digests differ."""
    columns = ["policy_id", "updated", "holder_name"]
    known = t.policy.where(F.col("start_date") <= F.lit(SNAPSHOT)).select("policy_id", F.col("start_date").alias("updated"), "holder_name")
    there = F.pmod("policy_id", F.lit(97)) != 0
    newer = today(t).where(there & ((F.pmod("policy_id", F.lit(11)) == 0) | (F.col("start_date") > F.lit(date(2001, 1, 1))))).select(*columns)
    kept = newer.unionByName(known.where(there).join(newer.select("policy_id"), "policy_id", "left_anti"))
    return changed_rows(kept, known, ["policy_id"], buckets=4096)


@query("keyed_merge", "policy_id:long updated:str", """
SELECT policy_id, updated FROM x_delta UNION ALL
SELECT policy_id, updated FROM x_yesterday WHERE policy_id NOT IN (SELECT policy_id FROM x_delta)""")
def keyed_merge(t: Tables) -> DataFrame:
    return I.keyed_merge(yesterday(t), delta(t).select("policy_id", "updated"), ["policy_id"])


LABELS = """SELECT holder_id, max(channel) FILTER (policy_status = 1) AS open_channel, max(region_code) AS region, {extra} AS n
FROM d_policy WHERE {where} GROUP BY 1"""
CTES["x_labels_old"] = LABELS.format(extra="count(*)", where=f"start_date <= DATE '{SNAPSHOT}'")
CTES["x_labels_new"] = LABELS.format(extra="sum(person_count)", where=f"start_date > DATE '{SNAPSHOT}'")


def labels(df: DataFrame, n) -> DataFrame:
    return df.groupBy("holder_id").agg(
        F.max(F.when(F.col("policy_status") == 1, F.col("channel"))).alias("open_channel"), F.max("region_code").alias("region"), n.alias("n")
    )


@query("label_merge", "holder_id:long open_channel:str region:str n:long", """
SELECT coalesce(n.holder_id, o.holder_id) AS holder_id, coalesce(n.open_channel, o.open_channel) AS open_channel,
  coalesce(n.region, o.region) AS region, coalesce(n.n, o.n) AS n
FROM x_labels_old o FULL JOIN x_labels_new n ON o.holder_id = n.holder_id""")
def label_merge(t: Tables) -> DataFrame:
    before = F.col("start_date") <= F.lit(SNAPSHOT)
    old = labels(t.policy.where(before), F.count(F.lit(1)))
    new = labels(t.policy.where(~before), F.sum("person_count"))
    return I.label_merge(old, new, "holder_id")


CTES["x_folded"] = """
WITH gone AS (SELECT key, max(seq) AS deleted_at FROM d_change_log WHERE type = 'DELETE' GROUP BY 1),
alive AS (SELECT c.* FROM d_change_log c LEFT JOIN gone g ON g.key = c.key
  WHERE type <> 'DELETE' AND (deleted_at IS NULL OR seq > deleted_at))
SELECT key, max(seq) AS seq, arg_max(value, seq) AS value, arg_min(props, seq) AS props FROM alive GROUP BY key"""


@query("cdc_apply", "key:long seq:long value:double props:str", "SELECT * FROM x_folded")
def cdc_apply(t: Tables) -> DataFrame:
    return I.fold_changes(t.change_log, "key", ["value"])


EVENT_STATE = ReplicatedTable("event_state", "events", "key", {"key": "bigint", "value": "double", "props": "string"}, ("value",))


def envelopes(changes: DataFrame) -> DataFrame:
    """Change rows as the JSON messages a replication feed would send."""
    data = F.array(F.create_map(
        F.lit("key"), F.col("key").cast("string"), F.lit("value"), F.col("value").cast("string"), F.lit("props"), F.col("props")
    ))
    return changes.select(F.to_json(F.struct(
        data.alias("data"), F.lit("replica").alias("database"), F.array(F.lit("key")).alias("pkNames"),
        F.lit(EVENT_STATE.name).alias("table"), "type", F.col("seq").alias("ts"),
    )).alias("value"))


@query("cdc_stream", "key:long seq:long value:double props:str", "SELECT * FROM x_folded")
def cdc_stream(t: Tables) -> DataFrame:
    """The same change log as a stream of messages, in as many micro-batches as there are files."""
    spark = t.spark
    schema = spark.read.parquet(f"{t.folder}/events.parquet").schema
    path = f"{shared_dir(spark)}/cdc-{uuid.uuid4().hex}"
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{t.folder}/events.parquet*")
    streamed = Tables(spark, t.folder)
    streamed.raw = lambda name: feed  # the adapter reads its events from the stream
    cdc.start(envelopes(streamed.change_log), EVENT_STATE, f"{path}/table", f"{path}/checkpoint", once=True).awaitTermination()
    return cdc.current(spark, EVENT_STATE, f"{path}/table").withColumn("seq", F.col("seq.ts"))


CTES["x_images"] = """
SELECT key, seq, epoch_ms(ts) AS ms, type, value, props, key IS NOT NULL AND seq % 5 = 0 AS imaged,
  CASE WHEN seq % 3 = 0 THEN value END AS old_value, CASE WHEN seq % 2 = 0 THEN 'k' ELSE props END AS old_props
FROM (SELECT c.*, e.ts FROM d_change_log c JOIN events e ON e.event_id = c.seq) WHERE key IS NOT NULL"""
CTES["x_linked"] = """
SELECT *, lag(type) OVER w AS was, lag(value) OVER w AS value_before, lag(props) OVER w AS props_before, lead(seq) OVER w AS until, lead(ms) OVER w AS until_ms,
  type <> 'DELETE' AND coalesce(lag(type) OVER w = 'DELETE', true) AS starts
FROM x_images WINDOW w AS (PARTITION BY key ORDER BY ms, seq)"""
CTES["x_history"] = """
SELECT *, CASE WHEN type <> 'DELETE' THEN last_value(CASE WHEN starts THEN seq END IGNORE NULLS)
  OVER (PARTITION BY key ORDER BY ms, seq ROWS UNBOUNDED PRECEDING) END AS begun FROM x_linked"""
#: A change's before-image: for every fifth change its value, every third of them as the change has it, and its properties.
IMAGED, HISTORY_DAYS = 5, 3


def imaged_changes(t: Tables) -> DataFrame:
    times = t.raw("events").select(F.col("event_id").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    changes = t.change_log.join(times, F.col("seq") == F.col("id"))
    value = F.when(F.col("seq") % 3 == 0, F.col("value")).cast("string")
    props = F.when(F.col("seq") % 2 == 0, "k").otherwise(F.col("props"))
    old = F.when(F.col("seq") % IMAGED == 0, F.create_map(F.lit("value"), value, F.lit("props"), props))
    return changes.select("key", F.struct(F.col("ms").alias("ts"), F.col("seq").alias("place")).alias("seq"), "type", "value", "props", old.alias("old"))


def key_versions(t: Tables) -> DataFrame:
    return history.history(imaged_changes(t), "key", HISTORY_DAYS * history.PERIOD)


@query("key_history", "key:long seq:long type:str value:double until:long starts:bool first_props:str", """
SELECT h.key, h.seq, h.type, h.value, h.until, h.starts, b.props AS first_props FROM x_history h LEFT JOIN x_images b ON b.seq = h.begun""")
def key_history(t: Tables) -> DataFrame:
    """Every change with the time it was the latest of its key, from changes in any order."""
    return key_versions(t).withColumns({"first_props": F.col("life.props"), "seq": F.col("seq.place"), "until": F.col("until.place")})


@query("history_gaps", "key:long seq:long reason:str columns:str", """
SELECT key, seq, reason, CASE WHEN reason = 'before' THEN names END AS columns FROM (SELECT *,
  CASE WHEN type = 'INSERT' AND was <> 'DELETE' THEN 'insert' WHEN type <> 'INSERT' AND coalesce(was = 'DELETE', true) THEN 'missing'
    WHEN type = 'UPDATE' AND imaged AND names <> '' THEN 'before' END AS reason
  FROM (SELECT *, concat_ws(',', CASE WHEN old_props IS DISTINCT FROM props_before THEN 'props' END,
    CASE WHEN old_value IS DISTINCT FROM value_before THEN 'value' END) AS names FROM x_linked)) WHERE reason IS NOT NULL""")
def history_gaps(t: Tables) -> DataFrame:
    """Changes that do not follow from the one before them: the feed has a gap there."""
    return history.gaps(key_versions(t), "key").withColumns({"seq": F.col("seq.place"), "columns": F.array_join("columns", ",")})


STATE_DAYS = [date(2024, 1, 5), date(2024, 1, 20), date(2024, 2, 1)]


@query("state_on_day", "day:str key:long seq:long value:double props:str", "\nUNION ALL ".join(f"""
SELECT '{day}' AS day, h.key, h.seq, h.value, b.props FROM x_history h JOIN x_images b ON b.seq = h.begun
WHERE h.ms <= epoch_ms(TIMESTAMP '{day}') AND (until_ms IS NULL OR until_ms > epoch_ms(TIMESTAMP '{day}'))""" for day in STATE_DAYS))
def state_on_day(t: Tables) -> DataFrame:
    """The table as it was at the beginning of several days, from one history."""
    versions = key_versions(t)
    days = F.array(*[F.lit(d) for d in STATE_DAYS])
    at = F.unix_millis(F.col("day").cast("timestamp"))
    held = history.valid_at(versions.withColumn("day", F.explode(days)), "key", ["value"], at, ["day"])
    return held.withColumn("seq", F.col("seq.place"))


CTES["x_vault_rows"] = """
SELECT CASE WHEN length(cert_no) = 18 THEN cert_no END AS cert_no, CASE WHEN workplace_id % 10 <> 0 THEN mobile END AS mobile,
  CASE WHEN person_id % 2 = 0 THEN 'official' ELSE 'inter' END AS business_line, start_date, end_date FROM d_insured"""


@query("pii_vault", "cert_no:str mobile:str business_line:str month:str cert_md5:str mobile_md5:str", f"""
WITH stored AS (SELECT DISTINCT cert_no, mobile, business_line FROM x_vault_rows WHERE coalesce(start_date, end_date) <= DATE '{SNAPSHOT}')
SELECT DISTINCT r.cert_no, r.mobile, r.business_line, strftime(coalesce(start_date, end_date), '%Y-%m') AS month,
  md5(r.cert_no) AS cert_md5, md5(r.mobile) AS mobile_md5
FROM x_vault_rows r LEFT JOIN stored s ON r.cert_no IS NOT DISTINCT FROM s.cert_no AND r.mobile IS NOT DISTINCT FROM s.mobile
  AND r.business_line = s.business_line
WHERE s.business_line IS NULL AND (r.cert_no IS NOT NULL OR r.mobile IS NOT NULL)""")
def pii_vault(t: Tables) -> DataFrame:
    none = F.lit(None).cast("date")
    rows = t.insured.select(
        F.when(F.length("cert_no") == 18, F.col("cert_no")).alias("cert_no"),
        F.when(F.pmod("workplace_id", F.lit(10)) != 0, F.col("mobile")).alias("mobile"),
        F.when(F.pmod("person_id", F.lit(2)) == 0, "official").otherwise("inter").alias("business_line"),
        F.col("start_date").alias("start"), F.col("end_date").alias("end"), none.alias("created"), none.alias("updated"),
    )
    stored = rows.where(F.coalesce("start", "end") <= F.lit(SNAPSHOT)).select("cert_no", "mobile", "business_line").distinct()
    return I.pii_vault(rows, stored, F.lit(AS_OF))


@query("all_business_person", "insured_id:str policy_id:long cert_no:str business_line:str month:str", f"""
SELECT insured_id, i.policy_id, cert_no, business_line, strftime(coalesce(i.start_date, i.end_date), '%Y-%m') AS month
FROM d_insured i JOIN d_policy p ON p.policy_id = i.policy_id JOIN d_product r ON r.product_code = p.product_code
WHERE p.start_date >= {TODAY} - 15 AND NOT EXISTS (SELECT 1 FROM d_policy q JOIN d_product z ON z.product_code = q.product_code
  WHERE q.policy_id = p.policy_id AND z.business_line = r.business_line AND q.start_date < {TODAY} - 5 AND q.policy_status = 0)""")
def all_business_person(t: Tables) -> DataFrame:
    lines = t.policy.join(t.product.select("product_code", "business_line"), "product_code")
    people = t.insured.join(lines.select("policy_id", "business_line", F.col("start_date").alias("created")), "policy_id").withColumnsRenamed(
        {"start_date": "start", "end_date": "end"}
    )
    stored = lines.where((F.col("start_date") < F.date_sub(F.lit(AS_OF), 5)) & (F.col("policy_status") == 0)).select("policy_id", "business_line")
    return I.new_people(people, stored, F.lit(AS_OF))


@query("shard_union", "policy_id:long version:long first_premium:double holder_name:str", """
SELECT policy_id, CASE WHEN start_date >= DATE '1998-06-01' THEN 2 ELSE 1 END AS version, first_premium, holder_name FROM d_policy""")
def shard_union(t: Tables) -> DataFrame:
    rows = t.policy.select("policy_id", "first_premium", "holder_name", "start_date")
    archived = rows.where("start_date <= date '1999-01-01'").withColumn("version", F.lit(1))
    current = rows.where("start_date >= date '1998-06-01'").withColumn("version", F.lit(2))
    return I.shard_union([archived, current], "policy_id", "version")


@query("backup_copy", "policy_id:long policy_code:str holder_name:str first_premium:double snapshot_day:str snapshot_week:str", f"""
SELECT policy_id, policy_code, holder_name, first_premium, strftime({TODAY}, '%Y%m%d') AS snapshot_day, strftime({TODAY}, '%G%V') AS snapshot_week FROM d_policy""")
def backup_copy(t: Tables) -> DataFrame:
    day = F.lit(AS_OF)
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))
    return t.policy.withColumns({"snapshot_day": F.date_format(day, "yyyyMMdd"), "snapshot_week": week})


LOADED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
          "labels", "conversations"]
CONFORMED = ["policy", "insured", "claim", "endorsement", "plan", "product", "sales"]


@query("job_status_log", "table:str rows:long status:long", "\nUNION ALL ".join(
    f"""SELECT '{name}' AS "table", count(*) AS rows, CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS status FROM {source}"""
    for name, source in [*((n, n) for n in LOADED), *((n, f"d_{n}") for n in CONFORMED)]))
def job_status_log(t: Tables) -> DataFrame:
    old = Q.status_log([("policy", t.policy), ("claim", t.claim)]).withColumn("version", F.lit(1))
    new = Q.status_log([*((n, t.raw(n)) for n in LOADED), *((n, getattr(t, n)) for n in CONFORMED)]).withColumn("version", F.lit(2))
    return I.shard_union([old, new], "table", "version")
