import json

from pyspark.sql import functions as F

from coverlake.streaming import cdc
from coverlake.streaming.tables import TABLES

RULE = TABLES["dm_graylist_rule"]


def message(ts, kind, *data, table=RULE.name):
    return json.dumps({"data": list(data), "database": "d", "pkNames": ["id"], "table": table, "type": kind, "ts": ts, "old": None})


MESSAGES = [
    message(1, "INSERT", {"id": "1", "rule_name": "a", "sort": "1", "create_time": "t1"}, {"id": "2", "rule_name": "b", "sort": "x", "create_time": "t1"}),
    message(2, "UPDATE", {"id": "1", "rule_name": "UPDATE dm_blacklist_ent", "sort": "2", "create_time": "t2"}),
    message(3, "DELETE", {"id": "2"}),
    message(4, "INSERT", {"id": "9", "rule_name": "dm_graylist_rule INSERT"}, table="dm_blacklist_ent"),
    message(5, "TRUNCATE", {"id": "1"}),
    message(6, "UPDATE", {"id": "1", "rule_name": "c"}, {"id": "1", "rule_name": "d"}),
    "not json",
]
WANT = {1: ("d", None, "t1")}


def state(df):
    return {r.id: (r.rule_name, r.sort, r.create_time) for r in df.collect()}


def test_envelopes_are_routed_by_their_fields_and_every_row_counts(spark):
    frame = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    changes = cdc.parse_envelope(frame, RULE)
    assert changes.count() == 6
    assert dict(changes.dtypes)["sort"] == "int"
    assert state(cdc.apply_changes(changes, RULE)) == WANT


def stream(spark, folder, batches):
    feed = folder / "feed"
    feed.mkdir()
    if not batches:
        return None
    for batch in batches:
        (feed / f"{len(list(feed.iterdir()))}.txt").write_text("\n".join(batch))
        source = spark.readStream.text(str(feed))
        cdc.start(source, RULE, str(folder / "table"), str(folder / "checkpoint"), once=True).awaitTermination()
    return cdc.current(spark, RULE, str(folder / "table"))


def test_what_cannot_be_read_is_kept_and_an_empty_log_is_empty(spark, tmp_path):
    bad = [message(7, "INSERT", {"id": "abc", "rule_name": "z"}), message(8, "INSERT", {"rule_name": "z"}), '{"data": 3}', "not json"]
    stream(spark, tmp_path, [])
    feed = spark.readStream.schema("value string").text(str(tmp_path / "feed"))
    cdc.start(feed, RULE, str(tmp_path / "table"), str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert cdc.current(spark, RULE, str(tmp_path / "table")).collect() == []
    (tmp_path / "feed" / "a.txt").write_text("\n".join([*MESSAGES, *bad]))
    cdc.start(feed, RULE, str(tmp_path / "table"), str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert state(cdc.current(spark, RULE, str(tmp_path / "table"))) == WANT
    got = sorted((r.reason, r.raw) for r in cdc.rejects(spark, RULE, str(tmp_path / "table")).collect())
    assert got == sorted([("key", bad[0]), ("key", bad[1]), ("text", bad[2]), ("text", bad[3]), ("text", "not json"), ("value", MESSAGES[0])])


def test_one_batch_and_many_batches_agree(spark, tmp_path_factory):
    one = stream(spark, tmp_path_factory.mktemp("one"), [MESSAGES])
    many = stream(spark, tmp_path_factory.mktemp("many"), [[m] for m in MESSAGES])
    late = stream(spark, tmp_path_factory.mktemp("late"), [MESSAGES[3:], MESSAGES[:3]])
    assert state(one) == state(many) == state(late) == WANT


def test_a_replayed_batch_changes_nothing_and_a_compacted_log_reads_the_same(spark, tmp_path):
    changes = cdc.parse_envelope(spark.createDataFrame([(m,) for m in MESSAGES], "value string"), RULE)
    for _ in range(2):
        cdc.append_changes(changes, 0, str(tmp_path))
    cdc.append_changes(changes.where(F.lit(False)), 1, str(tmp_path))
    log = spark.read.parquet(str(tmp_path / "changes")).drop("batch_id")
    assert log.count() == 6
    short = cdc.compact(log, RULE)
    assert short.count() < 6
    assert state(cdc.apply_changes(short, RULE)) == WANT


def test_eight_tables_with_their_update_columns():
    assert len(TABLES) == 8
    assert "create_time" not in TABLES["dm_blacklist_ent"].update
    assert len(TABLES["piwik_log_visit"].columns) == 64 and len(TABLES["piwik_log_visit"].update) == 14
