"""The training-data pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from coverlake.llm import stages
from coverlake.session import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", stages.good_documents),
    ("exact", stages.distinct_documents),
    ("simhash", stages.one_of_each_group),
    ("decontaminate", stages.without_benchmark),
    ("encode", stages.encoded),
]

#: A trained model and graph components cannot be said in SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole of ``documents``."""
    place = f"{shared_dir(spark)}/pipeline-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
