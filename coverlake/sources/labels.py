"""The label table: one row per person, one column per label, families as column prefixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from coverlake.operators.incremental import label_merge

FAMILIES = ("base_info", "cent_info", "high_info")


def read_cells(spark: SparkSession, path: str, key: str, family: str, labels: Sequence[str]) -> DataFrame:
    """Key and the chosen cells of one family; only those columns are read."""
    df = spark.read.parquet(path)
    return df.select(key, *[df[f"{family}__{c}"].alias(c) for c in labels if f"{family}__{c}" in df.columns])


def with_family(df: DataFrame, key: str, family: str) -> DataFrame:
    return df.select(key, *[df[c].alias(f"{family}__{c}") for c in df.columns if c != key])


def put_labels(spark: SparkSession, new: DataFrame, key: str, family: str, source: str, target: str) -> None:
    """Merge new labels over the stored ones and write the next version of the table, sorted by key within each file.

    All labels go out in one job; null and empty cells never overwrite.
    """
    merged = label_merge(spark.read.parquet(source), with_family(new, key, family), key)
    merged.sortWithinPartitions(key).write.mode("overwrite").parquet(target)
