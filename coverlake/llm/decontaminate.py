"""Benchmark decontamination with spaced seeds.

Texts and benchmark items are sequences of words, runs of letters and digits, A-Z like a-z. A mask picks some of the
positions under it and ignores the others, so a seed still hits where an ignored word was replaced. The masks are
chosen so that a passage of ``WINDOW`` words with up to two replaced words is hit by one of them wherever the two are.
Seeds of both sides are joined; a bit map of the items' seeds, of fixed size, keeps most other seeds of the documents
from being written at all, and the join is exact. Around each hit the two texts are laid side by side, and the longest
stretch that begins and ends with equal words and has ``SIMILAR`` of its words equal is taken.

A document holds an item if that stretch has ``WINDOW`` words, or covers an item that is shorter. With ``ends``, where it is
shorter because a word at an end was replaced, the ``WINDOW`` words (or the item) that lie beside each other count with
their ends, if ``SIMILAR`` of them are equal. Items of fewer than
``LEAST`` words are too common to tell and are not searched. Items of ``LEAST`` to ``WINDOW`` - 1 words also get a mask
without gaps, which finds them if ``LEAST`` words in a row are unchanged.

Defined cases: a null text is an empty one; only documents with an overlap have rows, one per document id, text and item (the longest
stretch, then the first); repeated rows give one; a null id stays null; empty tables give an empty result; further columns are not
looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.common import stored
from coverlake.llm.words import SIGNS, blocks, mix, stretch

MASKS = ("11010111", "111100000101")
WINDOW, LEAST, SIMILAR = 13, 5, 0.8
SHORT_MASK = "1" * LEAST
#: Bits of the map of item seeds: 2 MB, whatever the benchmark's size.
MAP_BITS = 24
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")

HIT = "doc_id long, text_hash long, region long, seed long, pos long, text binary"
FOUND = "doc_id long, text_hash long, item_id long, doc_from long, doc_to long, item_from long, item_to long, matched long, item_words long"


def words(raw: bytes) -> list[bytes]:
    return _WORDS.findall(raw.lower())


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the picked words at every position where the mask fits."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(mask), np.uint64)
    for k, picked in enumerate(mask):
        if picked == "1":
            out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    return mix(out)


def _marks(seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << MAP_BITS) - 1)
    return (seed & low).astype(np.int64), ((seed >> np.uint64(32)) & low).astype(np.int64)


def item_seeds(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``seed``, ``item_id``, ``item_pos``) of every item of ``LEAST`` words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for first, counts, hashes in blocks(batch.column("text"), gap=SIGNS):
                for k, part in enumerate(np.split(hashes, np.cumsum(counts)[:-1])):
                    masks = MASKS if len(part) >= WINDOW else (*MASKS, SHORT_MASK)
                    for mask in masks:
                        found = seeds(part, mask)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(found.view(np.int64)), pa.array([ids[first + k]] * len(found), pa.int64()), pa.array(np.arange(len(found)))],
                            names=["seed", "item_id", "item_pos"],
                        )

    base = items.select(items[id_col].cast("long").alias("item_id"), items[text_col].alias("text"))
    return base.mapInArrow(run, "seed long, item_id long, item_pos long")


def seed_map(table: DataFrame) -> np.ndarray:
    """The bit map of all seeds: bits of each task are put together per slot."""
    slots, width = 64, (1 << MAP_BITS) // 8 // 64

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.zeros(1 << MAP_BITS, bool)
        for batch in batches:
            for at in _marks(np.asarray(batch.column("seed")).view(np.uint64)):
                marked[at] = True
        packed = np.packbits(marked, bitorder="little").reshape(slots, width)
        used = [k for k in range(slots) if packed[k].any()]
        yield pa.RecordBatch.from_pydict({"slot": used, "bits": [packed[k].tobytes() for k in used]}, schema=schema)

    def either(frame):
        bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in frame["bits"]])
        return frame.iloc[:1].assign(bits=bits.tobytes())

    schema = pa.schema([("slot", pa.int64()), ("bits", pa.binary())])
    out = np.zeros((slots, width), np.uint8)
    marked = table.select("seed").mapInArrow(part, "slot long, bits binary")
    for r in marked.groupBy("slot").applyInPandas(either, "slot long, bits binary").collect():  # 2 MB at most
        out[r.slot] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def hits(docs: DataFrame, bits: np.ndarray, reach: int) -> DataFrame:
    """Seeds of documents that the map knows, and the text around them: ``reach`` words to each side, overlaps as one region."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = sent.value
        for batch in batches:
            for first, counts, hashes in blocks(batch.column("text"), gap=SIGNS):
                ends = np.cumsum(counts)
                found = []
                for mask in (*MASKS, SHORT_MASK):
                    seed = seeds(hashes, mask)
                    one = (seed & np.uint64((1 << MAP_BITS) - 1)).astype(np.uint32)
                    at = np.flatnonzero(marks[one >> 3] >> (one & 7).astype(np.uint8) & 1)
                    two = _marks(seed[at])[1]
                    at = at[(marks[two >> 3] >> (two & 7) & 1).astype(bool)]
                    row = np.searchsorted(ends, at, "right")
                    inside = at + len(mask) <= ends[row] if len(at) else np.zeros(0, bool)
                    found.append((row[inside], at[inside], seed[at[inside]]))
                rows, at, seed = (np.concatenate([f[k] for f in found]) for k in range(3))
                for row in np.unique(rows):
                    own = rows == row
                    pos = at[own] - (ends[row] - counts[row])
                    yield _rows(batch, first + int(row), pos, seed[own], reach)

    return docs.mapInArrow(run, HIT)


def _rows(batch: pa.RecordBatch, row: int, pos: np.ndarray, seed: np.ndarray, reach: int) -> pa.RecordBatch:
    """The hits of one document, each with the first word of its region, and a row with the text of each region."""
    order = np.argsort(pos, kind="stable")
    pos, seed = pos[order], seed[order]
    low, high = np.maximum(pos - reach, 0), pos + reach
    opens = np.concatenate([[True], low[1:] > np.maximum.accumulate(high)[:-1]])
    start, region = low[opens], low[opens][np.cumsum(opens) - 1]
    stop = np.array([high[region == s].max() for s in start])
    own = words(batch.column("text")[row].as_py().encode())
    texts = [b" ".join(own[a:b]) for a, b in zip(start.tolist(), stop.tolist())]
    n, m = len(pos), len(start)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([batch.column("doc_id")[row].as_py()] * (n + m), pa.int64()),
            pa.array([batch.column("text_hash")[row].as_py()] * (n + m), pa.int64()),
            pa.array(np.concatenate([region, start])),
            pa.array([*seed.view(np.int64).tolist(), *[None] * m], pa.int64()),
            pa.array([*pos.tolist(), *[None] * m], pa.int64()),
            pa.array([*[None] * n, *texts], pa.binary()),
        ],
        names=[x.split()[0] for x in HIT.split(", ")],
    )


def beside(same: np.ndarray, size: int) -> tuple[int, int]:
    """Place of ``size`` words, replaced ends included, with the most equal ones, if SIMILAR of them are; of equals the first."""
    if len(same) < size:
        return 0, 0
    sums = np.concatenate([[0], np.cumsum(same)])
    equal = sums[size:] - sums[:-size]
    k = int(equal.argmax())
    return (k, k + size) if equal[k] >= SIMILAR * size - 1e-9 else (0, 0)


def _verify(batches: Iterator[pa.RecordBatch], ends: bool) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in FOUND.split(", ")]
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            own, item = r["text"].split(b" "), words((r["item_text"] or "").encode())
            shift = r["diagonal"] - r["region"]  # item word k lies beside the region's word shift + k
            low, high = max(0, -shift), min(len(item), len(own) - shift)
            if high <= low:
                continue
            same = np.array([own[shift + k] == item[k] for k in range(low, high)])
            a, b = stretch(same, SIMILAR)
            size = min(WINDOW, len(item))
            if ends and b - a < size:
                a, b = beside(same, size)
            if b - a >= size:
                d = r["diagonal"] + low
                out.append([r["doc_id"], r["text_hash"], r["item_id"], d + a, d + b, low + a, low + b, int(same[a:b].sum()), len(item)])
        columns = zip(*out) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=names)


def overlaps(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", ends: bool = False
) -> DataFrame:
    """Documents that hold an item: ``doc_id``, ``text_hash``, ``item_id``, word positions of the stretch on both sides
    (``from`` included, ``to`` not), ``matched`` words and ``item_words``. ``ends``: a passage may begin or end with replaced words."""
    base = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("text_hash"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )
    known = stored(item_seeds(items, item_col, item_text))
    reach = known.agg(F.max("item_pos")).first()[0]
    reach = (reach or 0) + max(map(len, MASKS)) + 1
    found = stored(hits(base, seed_map(known), reach))
    key = ["doc_id", "text_hash", "region"]
    candidates = (
        found.filter("seed is not null").join(known, "seed")
        .select(*key, "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal"))
        .distinct()
    )
    regions = found.filter("seed is null").select(*key, "text").distinct()
    c, r = candidates.alias("c"), regions.alias("r")
    same = F.col("c.doc_id").eqNullSafe(F.col("r.doc_id")) & F.expr("c.text_hash = r.text_hash and c.region = r.region")
    texts = items.select(items[item_col].cast("long").alias("id"), items[item_text].alias("item_text")).distinct()
    checked = (
        c.join(r, same).select("c.*", "r.text").join(texts, F.col("item_id").eqNullSafe(F.col("id")))
        .select(*key, "item_id", "diagonal", "text", "item_text")
        .mapInArrow(lambda batches: _verify(batches, ends), FOUND)
    )
    value = F.struct("doc_from", "doc_to", "item_from", "item_to", "matched", "item_words")
    longest = F.struct(F.col("doc_to") - F.col("doc_from"), "matched", -F.col("doc_from"), -F.col("item_from"))
    return (
        checked.groupBy("doc_id", "text_hash", "item_id").agg(F.max_by(value, longest).alias("v")).select("doc_id", "text_hash", "item_id", "v.*")
    )
