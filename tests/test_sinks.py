from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from coverlake.session import shared_dir
from coverlake.sources import files, jdbc, labels


def test_slices_are_replaced_not_doubled(spark, rows, tmp_path):
    path = files.layer_path(str(tmp_path), "dw", "t")
    files.append_slices(rows("day string, x int", [("1", 1), ("2", 2)]), path, ["day"])
    for _ in range(2):
        files.replace_slices(rows("day string, x int", [("2", 5), ("2", 6)]), path, ["day"])
    assert sorted((r.day, r.x) for r in spark.read.parquet(path).select(F.col("day").cast("string"), "x").collect()) == [("1", 1), ("2", 5), ("2", 6)]
    plan = files.read_table(spark, path, ["x"], F.col("day") == 2)._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and files.read_months(spark, path, "day", ["1"]).count() == 1


def test_backup_keeps_other_days(spark, rows, tmp_path):
    df = rows("x int", [(1,)])
    for day in ("20200101", "20200102", "20200102"):
        files.backup(df, str(tmp_path / "b"), F.lit(day))
    assert spark.read.parquet(str(tmp_path / "b")).count() == 2


def test_full_refresh_text_and_guard(spark, rows, tmp_path):
    df = rows("x int", [(1,)])
    for _ in range(2):
        files.replace_table(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    files.write_text(df, str(tmp_path / "c"))
    assert spark.read.text(str(tmp_path / "c")).count() == 1
    written = []
    assert files.write_if_any(df, written.append) and not files.write_if_any(df.where("false"), written.append) and len(written) == 1
    stamped = files.stamped(df).first()
    assert len(stamped.id) == 32 and stamped.load_time is not None


def test_label_table(spark, rows, tmp_path):
    first, second = str(tmp_path / "v1"), str(tmp_path / "v2")
    labels.with_family(rows("cert string, a string, b string", [("x", "1", None)]), "cert", "cent_info").write.parquet(first)
    labels.put_labels(spark, rows("cert string, a string, b string", [("x", None, "2"), ("y", "3", "")]), "cert", "cent_info", first, second)
    got = {r.cert: (r.a, r.b) for r in labels.read_cells(spark, second, "cert", "cent_info", ["a", "b"]).collect()}
    assert got == {"x": ("1", "2"), "y": ("3", None)}


def test_month_predicates_lose_no_row():
    got = jdbc.month_predicates("t", [date(2020, 1, 1), date(2020, 2, 1)])
    assert len(got) == 4 and got[-1] == "t is null"
    assert got[2] == "date_format(t, '%Y-%m') not in ('2020-01', '2020-02')"
    assert jdbc.month_predicates("t", []) == ["t is not null", "t is null"]


def session(folder, master):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master=master))


def test_shared_folder_is_read_from_the_session():
    assert shared_dir(session("/shared/x/", "yarn")) == "/shared/x"
    assert shared_dir(session(None, "local[4]")) == shared_dir(session(None, "local[4]"))
    with pytest.raises(RuntimeError):
        shared_dir(session(None, "yarn"))
