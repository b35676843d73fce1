"""Helpers shared by the operators: tables, lineage cuts, connected components."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlake.session import shared_dir

#: A run of white space as the text operators see it, and the same class inverted.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write the rows as a Parquet table to the shared folder and go on from there: that cuts the lineage, so a lost
    executor costs a reread, not a rerun. Unlike a checkpoint it is computed once, compressed, and known to the planner by
    its size. The folder is the one the cluster names in ``spark.checkpoint.dir``.
    """
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_hash(text):
    """Hash of a text as it is; a null is an empty text. With the id it names a row, apart from equal rows."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def rows_named(docs: DataFrame, names: DataFrame, how: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose id and text hash are (``left_semi``) or are not (``left_anti``) among ``names``.

    ``names`` (``doc_id``, ``text_hash``) is written first, so that its size decides how it is joined.
    """
    n = stored(names.select(F.col("doc_id").alias("named_id"), F.col("text_hash").alias("named_hash")).distinct())
    same = docs[id_col].cast("long").eqNullSafe(n.named_id) & (text_hash(docs[text_col]) == n.named_hash)
    return docs.join(n, same, how)


def crc32_of_id(column: str = "doc_id"):
    """crc32 of the id written as text, the hash that deals documents to folds."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def held_out(column: str, folds: int, fold: int):
    """True where crc32(id as text) mod ``folds`` is ``fold``; a null id is never held out."""
    return F.coalesce(crc32_of_id(column) % folds == fold, F.lit(False))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges`` (``a``, ``b`` long) as (``node``, ``root``).

    Large-star and small-star steps in turn until nothing changes, which takes a number of rounds logarithmic in the
    length of chains. ``root`` is the smallest node. Minima are pre-aggregated before their shuffle and joined back, so
    a node with very many neighbours is never gathered in one task. Nodes without an edge do not appear.
    """
    pairs = stored(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )
    state = None
    while True:
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(pairs.select("lo", "hi"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(low, "hi")
            .select(F.explode(F.array(F.struct("hi", "m"), F.struct(F.col("lo").alias("hi"), "m"))).alias("e"))
            .select(F.col("e.hi").alias("hi"), F.col("e.m").alias("lo"))
            .filter("hi > lo")
            .distinct()
        )
        pairs = stored(small)
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
