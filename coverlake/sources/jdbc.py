"""Relational and column-store tables over JDBC: thin option sets, credentials come from the caller."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, DataFrameReader, SparkSession


def reader(spark: SparkSession, url: str, driver: str, user: str, password: str) -> DataFrameReader:
    return (
        spark.read.format("jdbc").option("url", url).option("driver", driver).option("user", user).option("password", password)
    )


def read_table(source: DataFrameReader, table: str) -> DataFrame:
    return source.option("dbtable", table).load()


def read_query(source: DataFrameReader, query: str) -> DataFrame:
    """Let the database run a query and read its result."""
    return source.option("query", query).load()


def read_by_id_range(source: DataFrameReader, table: str, column: str, low: int, high: int, partitions: int) -> DataFrame:
    """Read a table in parallel by ranges of a numeric column; rows outside [low, high] go to the outer ranges."""
    return (
        source.option("dbtable", table)
        .option("partitionColumn", column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", partitions)
        .load()
    )


def month_predicates(column: str, months: Sequence[date]) -> list[str]:
    """One predicate per month, one for all other months and one for rows without a date, so that no row is lost."""
    listed = ", ".join(f"'{m:%Y-%m}'" for m in months)
    each = [f"date_format({column}, '%Y-%m') = '{m:%Y-%m}'" for m in months]
    rest = [f"date_format({column}, '%Y-%m') not in ({listed})"] if months else [f"{column} is not null"]
    return [*each, *rest, f"{column} is null"]


def read_by_months(spark: SparkSession, url: str, table: str, predicates: Sequence[str], properties: dict[str, str]) -> DataFrame:
    """Read a table in parallel, one task per predicate."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)


def replace_table(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 50000) -> None:
    """Truncate and reload; the table's definition stays."""
    df.write.mode("overwrite").option("truncate", True).option("batchsize", batch_size).jdbc(url, table, properties=properties)


def append_table(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 50000) -> None:
    df.write.mode("append").option("batchsize", batch_size).jdbc(url, table, properties=properties)
