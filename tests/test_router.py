import glob
import json
import random

from coverlake.streaming import cdc, router
from coverlake.streaming.tables import TABLES

ALL = list(TABLES.values())
#: Tables whose states are compared: one with a column named like a change's own, two plain ones. The others are routed with them.
SHOWN = [TABLES[n] for n in ("dm_blacklist_worktype", "piwik_log_action", "dm_graylist_rule")]


def feed_of(rng, n):
    """Messages of all eight tables; numbers as text, some rows unreadable."""
    out = []
    for ts in range(n):
        table = rng.choice(ALL if n < 100 else SHOWN)
        rows = []
        for _ in range(rng.randrange(1, 4)):
            row = {c: str(rng.randrange(100)) for c in rng.sample(sorted(table.columns), 3)}
            rows.append(row | {table.key: str(rng.randrange(5)) if rng.random() < 0.95 else "bad"})
        kind = rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE", "TRUNCATE"])
        out.append(json.dumps({"data": rows, "database": "d", "pkNames": [table.key], "table": table.name, "type": kind, "ts": ts, "old": None}))
    return [*out, "not json", '{"data": 3}']


def state(df):
    return sorted((str(tuple(r)) for r in df.collect()))


def wanted(spark, messages, table):
    return state(cdc.apply_changes(cdc.parse_envelope(spark.createDataFrame([(m,) for m in messages], "value string"), table), table))


def run(spark, folder, batches, every=0):
    feed = folder / "feed"
    feed.mkdir(exist_ok=True)
    for batch in batches:
        (feed / f"{len(list(feed.iterdir())):04d}.txt").write_text("\n".join(batch))
        source = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(str(feed))
        router.start(source, ALL, str(folder / "t"), str(folder / "checkpoint"), once=True, compact_every=every).awaitTermination()
    return str(folder / "t")


def test_eight_tables_from_several_files_with_a_late_one_and_a_replay(spark, tmp_path):
    messages = feed_of(random.Random(2), 60)
    path = run(spark, tmp_path, [messages[20:40], messages[:20], messages[40:]])  # the second file is late
    assert {t.name: state(router.current(spark, t, path)) for t in SHOWN} == {t.name: wanted(spark, messages, t) for t in SHOWN}
    again = router.routed(spark.createDataFrame([(m,) for m in messages[:20]], "value string"), ALL)
    router.write_batch(again, 1, path)  # a replay of the second batch
    router.commit(spark, 1, path)
    assert state(router.current(spark, SHOWN[0], path)) == wanted(spark, messages, SHOWN[0])
    assert sorted(r.raw for r in router.rejects(spark, None, path).collect()) == sorted(["not json", '{"data": 3}'])
    for table in SHOWN[:1]:
        old = cdc.classified(spark.createDataFrame([(m,) for m in messages[:-2]], "value string"), table).where("reason is not null")
        assert sorted(r.raw for r in router.rejects(spark, table, path).collect()) == sorted(r.raw for r in old.collect())


def test_a_cut_between_two_tables_shows_nothing_and_its_replay_counts_once(spark, tmp_path):
    messages = feed_of(random.Random(3), 30)
    path = run(spark, tmp_path, [messages[:15]])
    before = {t.name: state(router.current(spark, t, path)) for t in SHOWN[:1]}
    rest = router.routed(spark.createDataFrame([(m,) for m in messages[15:]], "value string"), ALL)
    router.write_batch(rest.where(rest.table == SHOWN[0].name), 1, path)  # cut: one table written, no commit
    assert {t.name: state(router.current(spark, t, path)) for t in SHOWN[:1]} == before
    router.write_batch(rest, 1, path)
    router.commit(spark, 1, path)
    assert {t.name: state(router.current(spark, t, path)) for t in SHOWN[:1]} == {t.name: wanted(spark, messages, t) for t in SHOWN[:1]}


def test_compaction_keeps_the_state_the_readers_and_few_files(spark, tmp_path):
    tables = SHOWN[:1]
    messages = [m for m in feed_of(random.Random(5), 300) if any(f'"table": "{t.name}"' in m for t in tables)]
    path = str(tmp_path / "t")
    files = []
    size = -(-len(messages) // 6)
    parts = [messages[k * size : (k + 1) * size] for k in range(6)]  # in order: what compact asks for
    reader = None
    for batch_id, part in enumerate(parts):
        router.write_batch(router.routed(spark.createDataFrame([(m,) for m in part], "value string"), tables), batch_id, path)
        router.commit(spark, batch_id, path)
        if batch_id % 2 == 1:
            router.compact(spark, tables, path)
            router.clean(spark, tables, path)
            files.append(len(glob.glob(f"{path}/log/**/*.parquet", recursive=True)))
        if batch_id == 1:
            reader = router.held(spark, tables[0], path)
            frame = reader.__enter__()
            seen = state(frame)
        if batch_id > 1:
            assert state(frame) == seen  # the reader's version and batches are still there
    reader.__exit__(None, None, None)
    router.clean(spark, tables, path)
    for table in tables:
        with router.held(spark, table, path) as now:
            assert state(now) == wanted(spark, messages, table)
    assert len(glob.glob(f"{path}/log/**/*.parquet", recursive=True)) <= max(files)
    assert len(router._stored(spark, tables[0], path).versions()) == 2


def test_nothing_yet(spark, tmp_path):
    for table in SHOWN[:1]:
        assert router.current(spark, table, str(tmp_path)).collect() == []
        with router.held(spark, table, str(tmp_path)) as now:
            assert now.columns[0] == table.key and now.isEmpty()
