import glob
import os

import pytest
from pyspark.sql import functions as F

from coverlake.sources import versions as V
from coverlake.sources.versions import VersionedTable

SCHEMA = "id int, name string, amount double, day date"


def state(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def data(n, **changed):
    return [(k, changed.get(f"k{k}", f"name{k}") if k % 7 else None, k / 3, None) for k in range(n) if changed.get(f"k{k}") != "gone"]


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), ["id"], buckets=8)


def test_a_version_writes_only_changed_buckets_and_old_ones_stay_readable(spark, rows, table):
    first, second = data(200), data(200, k5="other", k9="gone") + [(900, "new", 1.0, None)]
    assert table.manifest() is None and table.write(rows(SCHEMA, first)).version == 1
    assert table.write(rows(SCHEMA, first).orderBy(F.desc("id")).repartition(5)).version == 1  # the same rows in another order
    made = table.write(rows(SCHEMA, second))
    assert made.version == 2 and state(table.read()) == sorted(second, key=str) and state(table.read(1)) == sorted(first, key=str)
    places = {p for p, _ in made.buckets.values()}
    assert len(places) == 2
    new = next(p for p in places if p not in {q for q, _ in table.manifest(1).buckets.values()})
    touched = {b for b, (p, _) in made.buckets.items() if p == new}
    assert 1 <= len(touched) <= 3
    moved = table.changes(1, 2)
    got = {(r.id, r.inc_type) for r in moved.collect()}
    assert got == {(5, V.UPDATED), (9, V.DELETED), (900, V.INSERTED)}
    read = {b for f in moved.inputFiles() for b in [int(f.split("_bucket=")[1].split("/")[0])]}
    assert read <= touched  # equal buckets are not in the scan
    assert {(r.id, r.inc_type) for r in V.changed_rows(rows(SCHEMA, second), rows(SCHEMA, first), ["id"], 8).collect()} == got


def test_digests_see_nulls_repeats_and_neighbouring_columns(rows):
    def one(values):
        return {r["_bucket"]: r.digest for r in V.digests(rows("k int, a string, b string", [(1, *v) for v in values]), ["k"], 4).collect()}

    kinds = [[("x", None)], [(None, "x")], [("x", "")], [("x", None), ("x", None)], [("x", None), ("x", None), ("x", None)], []]
    found = [one(k) for k in kinds]
    assert len({str(f) for f in found}) == len(kinds) and found[-1] == {}


def test_a_cut_copy_is_found_and_never_published(spark, rows, table, monkeypatch):
    made = table.write(rows(SCHEMA, data(100)))
    assert table.damaged(made) == []
    place, _ = made.buckets[3]
    victim = glob.glob(f"{table.path}/data/{place}/_bucket=3/*.parquet")[0]
    spark.read.parquet(victim).limit(2).coalesce(1).write.parquet(f"{table.path}/short")
    with open(glob.glob(f"{table.path}/short/*.parquet")[0], "rb") as short, open(victim, "wb") as target:
        target.write(short.read())
    for crc in glob.glob(f"{table.path}/data/{place}/_bucket=3/.*.crc"):
        os.remove(crc)
    assert table.damaged(made) == [3]
    monkeypatch.setattr(VersionedTable, "damaged", lambda self, *_: [1])
    with pytest.raises(V.Damaged):
        table.write(rows(SCHEMA, data(120)))
    assert table.versions() == [1]


def test_writers_exclude_each_other(spark, rows, table):
    table.write(rows(SCHEMA, data(10)))
    assert not table.folder.publish("versions/0000000001.json", "{}")
    assert table.manifest(1).version == 1 and not [n for n in table.folder.names("") if n.startswith("_new")]


def test_vacuum_keeps_what_is_read_or_labelled(spark, rows, table):
    for n in (50, 60, 70, 80):
        table.write(rows(SCHEMA, data(n)), label={50: "w1"}.get(n))
    with table.held(2) as version:
        assert table.vacuum(keep=1, labels=["w1"]) == [3]
        assert len(state(table.read(version))) == 60
    assert table.vacuum(keep=1, labels=["w1"]) == [2] and table.versions() == [1, 4]
    assert len(state(table.read())) == 80 and len(state(table.read(1))) == 50
    assert table.vacuum(keep=1) == [1] and len(state(table.read())) == 80
    assert {p for p, _ in table.manifest().buckets.values()} == set(table.folder.names("data"))


def test_empty_tables_new_columns_and_null_keys(spark, rows, table):
    assert table.write(rows(SCHEMA, [])).buckets == {} and table.read().collect() == []
    assert table.write(rows(SCHEMA, [(None, "a", None, None)])).version == 2
    assert state(table.changes(1, 2)) == [(None, "a", None, None, V.INSERTED)]
    wide = rows(SCHEMA + ", more int", [(None, "a", None, None, 5)])
    assert table.write(wide).version == 3 and table.read().columns[-1] == "more"
    assert table.write(wide.where("false")).version == 4 and table.read().collect() == []


def test_nine_tables_are_copied_once(spark, tmp_path):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "labels"]
    source = {n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in names}
    tables = {n: (df, df.columns[:1]) for n, df in source.items()}
    root = str(tmp_path / "backup")
    first = V.copy_tables(spark, tables, root, "20200101", 4)
    files = sorted(glob.glob(f"{root}/*/data/**/*.parquet", recursive=True))
    assert V.copy_tables(spark, tables, root, "20200101", 4) == first and set(first.values()) == {1}
    assert set(V.copy_tables(spark, tables, root, "2020W01", 4).values()) == {2}  # a label of its own, the same files
    assert sorted(glob.glob(f"{root}/*/data/**/*.parquet", recursive=True)) == files
    for name, df in source.items():
        copy = VersionedTable(spark, f"{root}/{name}", tables[name][1], 4)
        assert copy.damaged(copy.labelled("20200101")) == [] and copy.read().exceptAll(df).isEmpty() and copy.read().count() == df.count()
    assert V.expire_copies(spark, names[:2], root, ["2020W01"], 4) == {"region": [1], "nation": [1]}
