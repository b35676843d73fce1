"""Stages of the corpus pipeline. Each takes (spark, docs, folder) and calls one operator on all of ``docs``.

All but the last return rows of ``docs`` as they are. A null id is an id of its own kind, a null text is an empty one;
of rows equal in every column that names them (id and text), those that stay do so together until exact dedup, which
keeps one. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlake.llm import bpe, quality
from coverlake.llm.common import rows_named, stored, table, text_hash
from coverlake.llm.decontaminate import overlaps
from coverlake.llm.exact import exact_duplicates
from coverlake.llm.simhash import representatives

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def good_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.good(docs, quality.fit(docs, table(spark, folder, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal texts: the smallest id."""
    found = stored(exact_duplicates(docs).select("doc_id", "text_hash", "kept"))
    kept = rows_named(docs, found.filter("kept"), "left_semi")
    # rows of equal id and text come together; only where there are such rows is one of them picked
    again = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).filter("n > 1")
    if again.isEmpty():
        return kept
    same = rows_named(kept, again, "left_semi")
    key = {f"key_{c}": v for c, v in (("id", same["doc_id"]), ("hash", text_hash(same["text"])))}
    one = same.select(F.struct(*same.columns).alias("row"), *[v.alias(c) for c, v in key.items()]).dropDuplicates([*key]).select("row.*")
    return rows_named(kept, again, "left_anti").unionByName(one)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each SimHash component: the smallest id."""
    return rows_named(docs, representatives(docs, shingle=3, distance=2), "left_semi")


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return rows_named(docs, overlaps(docs, table(spark, folder, "benchmark"), ends=True), "left_anti")


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    coded = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY, "doc_id")
    return coded.select("doc_id", *bpe.digests(), "ids")
