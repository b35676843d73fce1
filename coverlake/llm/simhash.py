"""SimHash near duplicates by multi-index hashing.

The 64 bits of a fingerprint are cut into segments. If two fingerprints differ in at most ``distance`` bits, then by the
pigeonhole principle some segment differs in few: with ``distance = radius * segments + rest`` the first ``rest + 1``
segments are searched with ``radius`` and the others with ``radius - 1``. Every value of such a small Hamming ball is
looked up in the table of that segment, and hits are kept if the whole fingerprints are close enough, which is tested
inside the join. Copies share a fingerprint and are folded before the search. Links become components by star
contraction.

Defined cases: a null text is an empty one; a text without a word has fingerprint zero and is linked like any other; a text of fewer
words than a shingle has one shingle, the whole sequence; a component with null ids only has a null ``component_id``;
every input row gives one output row; an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from coverlake.llm.common import components, stored, text_hash

SEED = 42
BITS = 64
#: Shingles hashed at a time: bounds the array of single bits.
_SHINGLES = 1 << 14


def fingerprint(text: str, shingle: int = 3) -> int:
    """The unsigned SimHash of one text."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and exactly the white space meant
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[min(shingle, len(words)) - 1 :]
    ones = np.zeros(BITS, np.int64)
    for low in range(0, n, _SHINGLES):
        a, b = starts[low : min(n, low + _SHINGLES)].tolist(), last[low : min(n, low + _SHINGLES)].tolist()
        digests = b"".join([xxh64_digest(joined[i:j], SEED) for i, j in zip(a, b)])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(0, dtype=np.uint32)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _hash_rows(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(x.as_py() or "", shingle) for x in batch.column("text")], np.uint64)
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "print"])

    return run


def radii(segments: int, distance: int) -> list[int]:
    """Search radius of each segment; -1 is not searched."""
    radius, rest = divmod(distance, segments)
    return [radius if k <= rest else radius - 1 for k in range(segments)]


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` ones."""
    masks = {0}
    for _ in range(radius):
        masks |= {m | 1 << b for m in masks for b in range(width)}
    return sorted(masks)


def links(prints: DataFrame, distance: int, segments: int = 2) -> DataFrame:
    """Pairs (``a``, ``b``) of distinct fingerprints (column ``print``) that differ in at most ``distance`` bits."""
    width = BITS // segments
    masks = [(k, width * k, BITS - width * k if k == segments - 1 else width) for k in range(segments)]

    def value(column, at: int, bits: int):
        return F.shiftrightunsigned(F.shiftleft(column, BITS - at - bits), BITS - bits)

    own = F.array(*[F.struct(F.lit(k).alias("k"), value(F.col("print"), at, bits).alias("v")) for k, at, bits in masks])
    stored = prints.select(F.col("print").alias("a"), F.explode(own).alias("s")).select("a", "s.k", "s.v")
    searched = None
    for (k, at, bits), radius in zip(masks, radii(segments, distance)):
        if radius < 0:
            continue
        near = F.explode(F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in ball(bits, radius)]))
        probe = prints.select(F.col("print").alias("b"), F.lit(k).alias("k"), value(F.col("print"), at, bits).alias("own"), near.alias("mask"))
        probe = probe.select("b", "k", F.col("own").bitwiseXOR(F.col("mask")).alias("v"))
        searched = probe if searched is None else searched.union(probe)
    close = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    found = stored.join(searched, (stored.k == searched.k) & (stored.v == searched.v) & close)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, distance: int, segments: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``print``, ``root`` (of the component) and ``component_id`` of every row of ``docs``."""
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), text_hash(docs[text_col]).alias("text_hash"), docs[text_col].alias("text"))
    rows = stored(base.mapInArrow(_hash_rows(shingle), "doc_id long, text_hash long, print long"))
    distinct = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct.select("print"), distance, segments))
    named = distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(smallest, "root").select("print", "root", "component_id"), "print")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2, segments: int = 2
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``."""
    return grouped(docs, id_col, text_col, shingle, distance, segments).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2, segments: int = 2
) -> DataFrame:
    """The one row of each component that stays, as ``doc_id`` and ``text_hash``: the smallest id, nulls last, then the smallest hash."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    return grouped(docs, id_col, text_col, shingle, distance, segments).groupBy("root").agg(first).select("first.doc_id", "first.text_hash")
