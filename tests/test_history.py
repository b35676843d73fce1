import json
import random

import pytest
from pyspark.sql import functions as F

from coverlake.operators.incremental import fold_changes
from coverlake.streaming import cdc, history, router
from coverlake.streaming.tables import TABLES

SCHEMA = "key int, seq struct<ts: bigint, place: bigint>, type string, value int, made string, old map<string,string>"
UPDATE = ["value"]


def log(rng, n, keys=5, ts=400):
    """Changes in the order of their arrival, which is not their order; some come twice, some without a time."""
    out = []
    for i in range(n):
        key = rng.choice([0] * keys + list(range(keys)))  # one key holds more than half
        when = rng.randrange(ts) if rng.random() < 0.97 else None
        kind = rng.choice(["INSERT", "UPDATE", "UPDATE", "UPDATE", "DELETE"])
        old = rng.choice([None, {}, {"value": str(rng.randrange(4))}, {"value": "x", "made": None}, {"other": "1"}])
        out.append((key, (when, i), kind, rng.choice([None, *range(4)]), f"m{rng.randrange(6)}", old))
    return out + rng.sample(out, n // 5)


def plainly(changes):
    """History by a loop over each key's changes in order."""
    found = {}
    order = lambda c: (c[1][0] is not None, c[1][0] or 0, c[1][1])
    for key in {c[0] for c in changes}:
        mine = sorted({(c[0], c[1], c[2], c[3], c[4], None if c[5] is None else tuple(sorted(c[5].items()))) for c in changes if c[0] == key}, key=order)
        life, before = None, None
        for k, change in enumerate(mine):
            there = before is not None and before[2] != "DELETE"
            starts = change[2] != "DELETE" and not there
            life = (change[3], change[4]) if starts else life
            wrong = []
            for name, value in change[5] or ():
                at = {"value": 3, "made": 4}.get(name)
                if there and at and value != "x" and before[at] != (int(value) if value is not None and at == 3 else value):
                    wrong.append(name)
            reason = None
            if change[2] == "INSERT":
                reason = "insert" if there else None
            elif not there:
                reason = "missing"
            elif change[2] == "UPDATE" and wrong:
                reason = "before"
            until = mine[k + 1][1] if k + 1 < len(mine) else None
            found[key, change[1]] = (change[2:5], until, starts, life if change[2] != "DELETE" else None, reason, tuple(sorted(wrong)) if reason == "before" else None)
            before = change
    return found


def shown(versions):
    reasons = {(r.key, tuple(r.seq)): (r.reason, None if r["columns"] is None else tuple(r["columns"])) for r in history.gaps(versions, "key").collect()}
    rows = versions.collect()
    got = {}
    for r in rows:
        at = (r.key, tuple(r.seq))
        got[at] = ((r.type, r.value, r.made), r.until and tuple(r.until), r.starts, r.life and tuple(r.life), *reasons.get(at, (None, None)))
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("period", [1, 7, 100, 10_000])
def test_history_equals_a_loop_over_each_key(rows, period):
    changes = log(random.Random(period), 120)
    assert shown(history.history(rows(SCHEMA, changes), "key", period)) == plainly(changes)


def test_state_at_any_moment_equals_a_fold_up_to_it(rows):
    changes = log(random.Random(4), 150, ts=60)
    versions = history.history(rows(SCHEMA, changes), "key", 9).cache()
    log_rows = rows(SCHEMA, changes)
    for ts in (-1, 0, 13, 14, 37, 59, 1000):
        upto = log_rows.where(F.col("seq.ts").isNull() | (F.col("seq.ts") <= ts)).drop("old")
        want = sorted((r.key, tuple(r.seq), r.value, r.made) for r in fold_changes(upto, "key", UPDATE).select("key", "seq", "value", "made").collect())
        held = history.valid_at(versions, "key", UPDATE, F.lit(ts))
        assert sorted((r.key, tuple(r.seq), r.value, r.made) for r in held.collect()) == want, ts


def test_late_changes_fold_their_own_keys_again(rows):
    changes = log(random.Random(5), 120)
    early, late = changes[:90], [c for c in changes[90:] if c[0] in (0, 3)]
    stored = history.history(rows(SCHEMA, early), "key", 50)
    assert shown(history.extend(stored, rows(SCHEMA, late), "key", 50)) == plainly(early + late)


def test_no_changes_no_keys_and_no_before_images(rows):
    none = rows(SCHEMA, [])
    assert history.history(none, "key").collect() == [] and history.gaps(history.history(none, "key"), "key").collect() == []
    assert history.history(rows(SCHEMA, [(None, (1, 0), "INSERT", 1, "a", None)]), "key").collect() == []
    bare = rows(SCHEMA, [(1, (1, 0), "INSERT", 1, "a", None), (1, (2, 0), "UPDATE", 2, "b", None)]).drop("old")
    assert history.gaps(history.history(bare, "key"), "key").collect() == []


def test_a_hot_key_spreads_over_its_periods(rows, spark):
    """No sort of the history holds more of a key than one period of it."""
    hot = spark.range(20_000).select(
        F.lit(1).alias("key"), F.struct((F.col("id") % 1000).alias("ts"), F.col("id").alias("place")).alias("seq"),
        F.lit("UPDATE").alias("type"), F.col("id").cast("int").alias("value"), F.lit("m").alias("made"), F.lit(None).cast("map<string,string>").alias("old"),
    )
    versions = history.history(hot, "key", 10)
    plan = versions._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line and "seq#" in line]
    assert sorts and all("_range#" in line for line in sorts)
    assert versions.where("until is null").count() == 1 and versions.where("starts").count() == 1


def test_router_keeps_a_history_that_compaction_does_not_shorten(spark, tmp_path):
    table, rng = TABLES["dm_blacklist_worktype"], random.Random(6)  # it has a column named like a change's own
    path, messages, times = str(tmp_path), [], rng.sample(range(100), 100)
    for batch in range(4):
        part = []
        for i in range(25):
            data = [{"id": str(rng.randrange(4)), "type": str(rng.randrange(3)), "create_time": f"t{batch}{i}"} for _ in range(2)]
            old = rng.choice([None, "none", [{"type": "1"}, {"status": None}]])
            kind = rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"])
            part.append(json.dumps({"data": data, "table": table.name, "type": kind, "ts": times.pop(), "old": old}))
        messages += part
        router.write_batch(router.routed(spark.createDataFrame([(m,) for m in part], "value string"), [table]), batch, path)
        router.commit(spark, batch, path)
        assert router.keep_history(spark, [table], path) == batch
        if batch == 2:
            router.compact(spark, [table], path)
            assert router.clean(spark, [table], path) == [0, 1, 2]
    changes = cdc.parse_envelope(spark.createDataFrame([(m,) for m in messages], "value string"), table)
    columns = ["seq", *table.columns]
    for ts in (-1, 31, 70, 100):
        want = cdc.apply_changes(changes.where(F.col("seq.ts") <= ts), table).select(columns)
        got = router.state_at(spark, table, path, ts).select(columns)
        assert sorted(str(r) for r in got.collect()) == sorted(str(r) for r in want.collect()), ts
