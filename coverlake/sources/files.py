"""Warehouse layers on files: full refresh, slices by day or month, text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def layer_path(root: str, layer: str, table: str) -> str:
    """A layer (``ods``, ``dw``, ``dm``, ``label``, ``backup``) is a path prefix."""
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    """Scan with projection and filter, both of which reach the file reader."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_months(spark: SparkSession, path: str, column: str, months: Sequence[str]) -> DataFrame:
    """Only the partitions of the given months."""
    return spark.read.parquet(path).where(F.col(column).isin(list(months)))


def replace_table(df: DataFrame, path: str) -> None:
    """Full refresh in one step; readers never see an empty table between a truncate and an append."""
    df.write.mode("overwrite").parquet(path)


def replace_slices(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df``: a rerun of a day or month is idempotent.

    Rows are laid out by the partition columns first, so a slice is not scattered over every task; AQE splits a slice that
    is too large for one.
    """
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append_slices(df: DataFrame, path: str, by: Sequence[str]) -> None:
    df.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)


def write_text(df: DataFrame, path: str, separator: str = ",") -> None:
    df.write.mode("overwrite").option("sep", separator).csv(path)


def write_if_any(df: DataFrame, write) -> bool:
    """Write only if there is a row; says whether it wrote."""
    if df.isEmpty():
        return False
    write(df)
    return True


def stamped(df: DataFrame) -> DataFrame:
    """Row id and load time, added on the way out and never before."""
    return df.withColumns({"id": F.replace(F.expr("uuid()"), F.lit("-"), F.lit("")), "load_time": F.current_timestamp()})


def backup(df: DataFrame, path: str, snapshot: Column) -> None:
    """Full copy of a table under its snapshot day; a rerun replaces that day only."""
    replace_slices(df.withColumn("snapshot_day", snapshot), path, ["snapshot_day"])
