"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Per n-gram, the ratio of its smoothed share among toxic and among other training documents gives ``r = log(p / q)``. A
document is the set of its n-grams, each with the value ``r``; a logistic regression with L2 penalty learns a weight
for each. N-grams are hashed to ``BUCKETS``. Only those that tell enter the regression: in ``LEAST_DOCS`` documents, with a
log-count ratio of ``LEAST_RATIO``, and with a log-likelihood ratio of presence against label that chance would rarely give among as many n-grams as were looked
at (``CHANCE``). Without that, the n-grams that three toxic texts share by chance fit the training rows and say nothing of
others. A logistic curve, learned from scores that each inner fold gets from a model of the others, makes the score a
probability. Counting and scoring run in Spark over whole texts; the regressions run on a bounded sample (``rows``), one task each.

Defined cases: a null or empty text is scored like a text without any telling n-gram; without both labels in the
sample every score is 0; every input row gives one output row, repeated rows too; an empty table gives an empty result;
further columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlake.llm.common import held_out
from coverlake.llm.training import FOLDS, HELD_OUT, Adam, calibrate, sample, sigmoid
from coverlake.llm.words import text_buffers

SIZES = (3, 4, 5, 6)
BITS = 19
BUCKETS = 1 << BITS
#: An n-gram tells from a likelihood ratio of ``CHANCE`` times the log of the number of n-grams in ``LEAST_DOCS`` documents on.
CHANCE, LEAST_DOCS, LEAST_RATIO = 1.5, 3, 1.0
PENALTY, STEPS = 1e-3, 300
#: Folds inside the training rows that the score is calibrated by.
INNER = 8
#: Labelled documents learned from at most.
ROWS = 24_000
THRESHOLD = 0.7
_BLOCK = 1 << 19
_SLOT = 1 << 15
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32


def grams(data: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket of the n-gram that starts at each byte, for each size; ``data`` is one or more texts end to end."""
    signs = _LOWER[data] + np.uint32(1)
    for size in SIZES:
        if len(signs) < size:
            continue
        h = np.full(len(signs) - size + 1, size, np.uint32)
        for k in range(size):
            h = (h ^ signs[k : k + len(h)]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        yield (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def features(column: pa.Array, keep: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first, last, row, bucket): the distinct kept buckets of each text. Long texts go in overlapping blocks."""
    data, offsets = text_buffers(column)
    row, rows, reach = 0, len(column), max(SIZES) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _BLOCK, "right")) - 1)
        found = []
        for low in range(int(offsets[row]), max(int(offsets[stop]), int(offsets[row]) + 1), _BLOCK):
            block = data[low : min(low + _BLOCK + reach, int(offsets[stop]))]
            for size, bucket in zip(SIZES, grams(block)):
                at = np.flatnonzero(keep[bucket])
                owner = np.searchsorted(offsets[row : stop + 1], at + low, "right") - 1
                inside = at + low + size <= offsets[row + owner + 1]
                found.append((owner[inside].astype(np.int64) << BITS) | bucket[at[inside]])
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        yield row, stop, row + (pairs >> BITS), pairs & (BUCKETS - 1)
        row = stop


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # per bucket: regression weight times log ratio
    shift: float


def counted(labelled: DataFrame) -> np.ndarray:
    """How many documents of each inner fold and label have each bucket, and in the last place how many there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everything, counts, seen = np.ones(BUCKETS, bool), np.zeros((2 * INNER, BUCKETS), "<i4"), False
        for batch in batches:
            group = 2 * np.asarray(batch.column("fold")) + np.asarray(batch.column("label"))
            for _, _, row, bucket in features(batch.column("text"), everything):
                seen = True
                for k in range(2 * INNER):
                    counts[k] += np.bincount(bucket[group[row] == k], minlength=BUCKETS).astype("<i4")
        if seen:
            slots = counts.reshape(2 * INNER, -1, _SLOT).swapaxes(0, 1)
            yield pa.RecordBatch.from_pydict({"slot": list(range(len(slots))), "counts": [zlib.compress(s.tobytes(), 1) for s in slots]}, schema=schema)

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(2 * INNER * _SLOT, "<i4")
        for x in frame["counts"]:
            total += np.frombuffer(zlib.decompress(x), "<i4")
        return pd.DataFrame({"slot": frame["slot"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})

    schema = pa.schema([("slot", pa.int64()), ("counts", pa.binary())])
    parts = labelled.mapInArrow(count, "slot long, counts binary").groupBy("slot").applyInPandas(add, "slot long, counts binary")
    counts = np.zeros((INNER, 2, BUCKETS + 1), "<i4")
    for r in parts.collect():  # BUCKETS numbers a class and fold, whatever the input
        counts[:, :, r.slot * _SLOT : (r.slot + 1) * _SLOT] = np.frombuffer(zlib.decompress(r.counts), "<i4").reshape(INNER, 2, -1)
    for r in labelled.groupBy("fold", "label").count().collect():
        counts[r.fold, r.label, BUCKETS] = r["count"]
    return counts


def telling(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket the log of its share in toxic over its share in other documents, and whether it tells."""
    have, every = counts[:, :BUCKETS].astype(float), counts[:, BUCKETS:].astype(float)
    share = (have + 1) / (have + 1).sum(1, keepdims=True)
    seen = have.sum(0)
    if not every.all():
        return np.zeros(BUCKETS), np.zeros(BUCKETS, bool)
    wanted = seen * every / every.sum()
    ratio = np.zeros(BUCKETS)
    with np.errstate(divide="ignore", invalid="ignore"):
        for found, expected in ((have, wanted), (every - have, every - wanted)):
            ratio += 2 * np.where(found > 0, found * np.log(found / expected), 0).sum(0)
    often = seen >= LEAST_DOCS
    log_ratio = np.log(share[1] / share[0])
    return log_ratio, often & (np.abs(log_ratio) >= LEAST_RATIO) & (ratio >= CHANCE * np.log(max(often.sum(), 2)))


@dataclass(frozen=True)
class _Sets:
    """The kept n-grams (``column``) of the sampled documents, end to end."""

    owner: np.ndarray
    column: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    fold: np.ndarray

    def regress(self, without: int, ratio: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, float] | None:
        """Weight of each column times its ratio, and the shift, learned from the documents of all folds but one."""
        rows = self.fold != without
        y, each = self.label[rows], self.weight[rows] / self.weight[rows].sum()
        if len(set(y)) < 2:
            return None
        place, number = (np.cumsum(x, dtype=np.int32) - np.int32(1) for x in (rows, keep))
        at = np.flatnonzero(rows[self.owner] & keep[self.column])
        used, feature, owner = np.flatnonzero(keep), number[self.column[at]], place[self.owner[at]]
        order = np.argsort(feature, kind="stable")
        owner_of, first_of = owner[order], _starts(feature[order])
        first = _starts(owner)
        docs, features_of = owner[first], feature[order][first_of]
        scale = ratio[used]
        w, adam = np.zeros(len(used) + 1), Adam(len(used) + 1, 0.02)
        for _ in range(STEPS):
            z = np.full(len(y), w[-1])
            z[docs] += np.add.reduceat((w[:-1] * scale)[feature], first)
            error = each * (sigmoid(z) - y)
            slope = PENALTY * w[:-1]
            slope[features_of] += np.add.reduceat(error[owner_of], first_of) * scale[features_of]
            w -= adam.step(np.append(slope, error.sum()))
        weights = np.zeros(len(keep))
        weights[used] = w[:-1] * scale
        return weights, float(w[-1])

    def scores(self, weights: np.ndarray, shift: float) -> np.ndarray:
        return np.bincount(self.owner, weights[self.column], len(self.label)) + shift


def _starts(x: np.ndarray) -> np.ndarray:
    """Places at which a sorted array takes a new value."""
    return np.flatnonzero(np.diff(x, prepend=-1))


def regressions(spark: SparkSession, sets: _Sets, models: list[tuple[np.ndarray, np.ndarray]]) -> dict[int, tuple[np.ndarray, float]]:
    """One task per model: model k leaves fold k out. ``models`` are the ratio and the keep mask of each."""
    sent = spark.sparkContext.broadcast((sets, models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, each = sent.value
        for batch in batches:
            for k in batch.column("id").to_pylist():
                if (got := known.regress(k, *each[k])) is not None:
                    yield pa.RecordBatch.from_pydict({"id": [k], "weights": [got[0].astype("<f8").tobytes()], "shift": [got[1]]}, schema=schema)

    schema = pa.schema([("id", pa.int64()), ("weights", pa.binary()), ("shift", pa.float64())])
    got = spark.range(0, len(models), 1, len(models)).mapInArrow(run, "id long, weights binary, shift double").collect()
    return {r.id: (np.frombuffer(r.weights, "<f8"), r.shift) for r in got}


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from at most ``rows`` labelled documents outside the held-out fold."""
    labelled, weight = sample(docs, labels, label, rows, id_col, text_col)
    labelled = labelled.withColumn("fold", F.pmod(F.xxhash64(F.lit("inner"), "doc_id"), F.lit(INNER)).cast("int"))
    counts = counted(labelled)
    whole = counts.sum(0)
    parts = [telling(whole - counts[k]) for k in range(INNER)]
    ratio, keep = telling(whole)
    any_of = keep | np.any([k for _, k in parts], axis=0)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, row, bucket in features(batch.column("text"), any_of):
                ends = np.searchsorted(row, np.arange(first, stop + 1))
                each = [bucket[a:b].astype("<i4").tobytes() for a, b in zip(ends, ends[1:])]
                own = [batch.column(c).slice(first, stop - first) for c in ("label", "fold")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(each, pa.binary())], names=["label", "fold", "buckets"])

    got = labelled.mapInArrow(vectors, "label int, fold int, buckets binary").collect()  # at most ``rows`` sets of kept buckets
    y, fold = np.array([r.label for r in got], float), np.array([r.fold for r in got])
    if len(set(y)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), -40.0)
    lists = [np.frombuffer(r.buckets, "<i4") for r in got]
    column = np.cumsum(any_of, dtype=np.int32) - np.int32(1)
    owner = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists])
    sets = _Sets(owner, column[np.concatenate(lists)], y, np.where(y == 0, weight, 1.0), fold)
    del got, lists
    found = regressions(docs.sparkSession, sets, [(r[any_of], k[any_of]) for r, k in [*parts, (ratio, keep)]])
    unseen, known = np.zeros(len(y)), np.zeros(len(y), bool)
    for k in range(INNER):
        if k in found:
            unseen[fold == k], known[fold == k] = sets.scores(*found[k])[fold == k], True
    slope, level = calibrate(unseen[known], y[known], sets.weight[known]) if len(set(y[known])) == 2 else (1.0, 0.0)
    slope = max(slope, 0.0)  # no signal
    own, shift = found[INNER]
    weights = np.zeros(BUCKETS)
    weights[any_of] = own
    return Model((slope * weights).astype(np.float32), slope * shift + level)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of every row. The model is one array of BUCKETS numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, shift = sent.value.weights, sent.value.shift
        keep = weights != 0
        for batch in batches:
            z = np.full(batch.num_rows, shift)
            for _, _, row, bucket in features(batch.column("text"), keep):
                z += np.bincount(row, weights[bucket], batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sigmoid(z))], names=["doc_id", "score"])

    base = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return base.mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``."""
    model = fit(docs, labels, label, rows, id_col, text_col)
    return score(docs, model, id_col, text_col).select(
        "doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
