"""Exact duplicates by composable polynomial fingerprints.

Two texts are equal when they are identical after every run of white space has become one space. The bytes of that
form are read as two-byte digits of a polynomial modulo 2**31-1, with two bases. Digits are hashed chunk by chunk, and
hashes of neighbouring parts combine as ``hash(AB) = hash(A) * base**len(B) + hash(B)``. A text above ``huge`` bytes is
dealt out in parts, which different tasks hash; their hashes are combined afterwards. Texts of one fingerprint are then
compared chunk by chunk: per chunk the smallest and the largest content of a group must be the same, which partial
aggregation finds without bringing a group together. Where they differ, the group is split by SHA-256.

Defined cases: a null text is an empty one; empty texts equal each other; a text of white space only equals one space; a null id comes after
all others, and a group of null ids keeps one row; of rows with equal id and text exactly one is kept; every input row
gives one output row; an empty table gives an empty result; further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlake.llm.common import SPACES, stored, text_hash

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_812_433_253)
#: Bytes of a chunk (even), and of the largest text that one task hashes alone (a multiple of the chunk).
CHUNK = 1 << 16
HUGE = 1 << 23

KEY = ["h1", "h2", "n_bytes"]
PART = "row long, doc_id long, text_hash long, text_sha256 string, n_bytes long, part long, h1 long, h2 long, shift1 long, shift2 long"


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


@cache
def _powers(digits: int, prime: int) -> tuple[np.ndarray, ...]:
    """base**(digits-1) ... base**0 for each base."""
    out = []
    for base in BASES:
        column = [1]
        for _ in range(digits - 1):
            column.append(column[-1] * base % prime)
        out.append(np.array(column[::-1], np.uint64))
    return tuple(out)


def fingerprint(raw: bytes, chunk: int = CHUNK, prime: int = PRIME) -> tuple[int, int, int, int]:
    """Two hashes of the bytes and the two factors by which a left neighbour's hashes move when this part follows."""
    first, second = _powers(chunk // 2, prime)
    shifts = [int(p[0]) * b % prime for p, b in zip((first, second), BASES)]  # base ** digits of a full chunk
    h, s = [0, 0], [1, 1]
    for low in range(0, len(raw), chunk):
        piece = raw[low : low + chunk]
        if len(piece) % 2:
            piece += b"\0"
        digits = np.frombuffer(piece, "<u2").astype(np.uint64)
        n = len(digits)
        for k, powers in enumerate((first, second)):
            own = int(digits @ powers[len(powers) - n :]) % prime
            move = shifts[k] if n == chunk // 2 else int(powers[len(powers) - n]) * BASES[k] % prime
            h[k] = (h[k] * move + own) % prime
            s[k] = s[k] * move % prime
    return *h, *s


def _hash_parts(chunk: int, prime: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fingerprint(x.as_py(), chunk, prime) for x in batch.column("raw")]
            columns = [pa.array([g[k] for g in got], pa.int64()) for k in range(4)]
            kept = [batch.column(n) for n in ("row", "doc_id", "text_hash", "text_sha256", "n_bytes", "part")]
            yield pa.RecordBatch.from_arrays(kept + columns, names=[x.split()[0] for x in PART.split(", ")])

    return run


def fingerprints(docs: DataFrame, id_col: str, text_col: str, huge: int = HUGE, chunk: int = CHUNK, prime: int = PRIME) -> DataFrame:
    """One row per input row: ``doc_id``, ``text_hash`` (of the text as it is), ``text_sha256``, ``n_bytes`` and the
    fingerprint ``h1``, ``h2``."""
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    size = F.octet_length(F.coalesce("text", F.lit("")))

    def prepared(df: DataFrame) -> DataFrame:
        raw = df.select("doc_id", text_hash(F.col("text")).alias("text_hash"), normal(F.col("text")).cast("binary").alias("raw"))
        return raw.select("doc_id", "text_hash", F.sha2("raw", 256).alias("text_sha256"), F.octet_length("raw").cast("long").alias("n_bytes"), "raw")

    def hashed(df: DataFrame) -> DataFrame:
        columns = ["row", "doc_id", "text_hash", "text_sha256", "n_bytes", "part", "raw"]
        return df.select(*columns).mapInArrow(_hash_parts(chunk, prime), PART)

    whole = hashed(prepared(base.filter(size <= huge)).withColumns({"row": F.lit(0).cast("long"), "part": F.lit(0).cast("long")}))
    parts = (
        prepared(base.filter(size > huge))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.expr(f"(n_bytes - 1) div {huge}")))))
        .withColumn("raw", F.expr(f"substring(raw, cast(part * {huge} + 1 as int), {huge})"))
        .repartition("row", "part")
    )

    def joined(k: int) -> Column:
        step = lambda acc, x: F.pmod(acc * x[f"shift{k}"] + x[f"h{k}"], F.lit(prime).cast("long"))
        return F.aggregate("parts", F.lit(0).cast("long"), step).alias(f"h{k}")

    combined = (
        hashed(parts)
        .groupBy("row", "doc_id", "text_hash", "text_sha256", "n_bytes")
        .agg(F.array_sort(F.collect_list(F.struct("part", "h1", "h2", "shift1", "shift2"))).alias("parts"))
        .select("doc_id", "text_hash", "text_sha256", "n_bytes", joined(1), joined(2))
    )
    return whole.select("doc_id", "text_hash", "text_sha256", "n_bytes", "h1", "h2").union(combined)


def mixed_groups(docs: DataFrame, prints: DataFrame, id_col: str, text_col: str, chunk: int = CHUNK) -> DataFrame:
    """Fingerprints whose texts are not all the same, found chunk by chunk."""
    multi = prints.groupBy(*KEY).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    members = prints.join(multi, KEY).select("doc_id", "text_sha256", *KEY).distinct()
    raw = docs.select(docs[id_col].cast("long").alias("id"), normal(docs[text_col]).cast("binary").alias("raw"))
    raw = raw.withColumn("sha", F.sha2("raw", 256))
    chunks = (
        raw.join(members, raw.id.eqNullSafe(members.doc_id) & (raw.sha == members.text_sha256))
        .select(*KEY, "raw", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(0L, (n_bytes - 1) div {chunk})"))).alias("k"))
        .select(*KEY, "k", F.expr(f"substring(raw, cast(k * {chunk} + 1 as int), {chunk})").alias("piece"))
    )
    return (
        chunks.groupBy(*KEY, "k")
        .agg(F.min("piece").alias("low"), F.max("piece").alias("high"))
        .filter("low <> high")
        .select(*KEY)
        .distinct()
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", huge: int = HUGE, chunk: int = CHUNK, prime: int = PRIME
) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``n_bytes`` and ``text_hash`` of every row of ``docs``."""
    prints = fingerprints(docs, id_col, text_col, huge, chunk, prime)
    prints = stored(prints.withColumn("row", F.monotonically_increasing_id()))  # fixed from here on, as the rows are written
    mixed = mixed_groups(docs, prints, id_col, text_col, chunk).withColumn("mixed", F.lit(True))
    key = [*KEY, "split"]
    rows = stored(
        prints.join(mixed, KEY, "left")
        .withColumn("split", F.when(F.col("mixed"), F.col("text_sha256")).otherwise(F.lit("")))
        .drop("mixed")
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    # written first, so that the join below is not bound to the grouping's partitions and a hot group can be split
    groups = stored(rows.groupBy(*key).agg(first, F.count("*").alias("group_size")))
    return rows.join(groups, key).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
        "n_bytes",
        "text_hash",
    )
