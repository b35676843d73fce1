"""Bounded samples of labelled documents, and a small logistic regression over sparse or dense rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.common import held_out

#: Documents are dealt to folds by crc32(id as text) mod FOLDS; labels of fold HELD_OUT are never learned from.
FOLDS, HELD_OUT = 3, 1


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, float]:
    """Up to ``rows`` / 2 labelled documents of each class, as (``doc_id``, ``text``, ``label``), and the weight of class 0.

    Rows are taken in the order of a hash of their id. Ids without a label, with contradicting labels or in the held-out
    fold are left out. The ids, at most ``rows`` of them, are sent to the scan of the documents; no text is shuffled.
    The weight makes up for classes taken in another proportion than they have.
    """
    clean = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("id", FOLDS, HELD_OUT))
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .filter("label = most").drop("most")
    )
    count = {r.label: r.n for r in clean.groupBy("label").agg(F.count("*").alias("n")).collect()}
    taken = [clean.filter(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(rows // 2) for k in (0, 1)]
    ids = taken[0].union(taken[1]).toPandas()
    got = ids["label"].value_counts()
    weight = 1.0
    if len(got) == 2:
        weight = (count[0] / int(got[0])) / (count[1] / int(got[1]))
    known = docs.sparkSession.createDataFrame(ids, "id long, label int")
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return base.join(F.broadcast(known), base.doc_id == known.id).select("doc_id", "text", "label"), weight


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    """Gradient steps of adapted size."""

    def __init__(self, n: int, rate: float) -> None:
        self.m, self.v, self.t, self.rate = np.zeros(n), np.zeros(n), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient**2 - self.v)
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def calibrate(score: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 2000) -> tuple[float, float]:
    """Slope and shift of a logistic curve from a score to the label."""
    w, adam = np.array([1.0, 0.0]), Adam(2, 0.05)
    for _ in range(rounds):
        error = weight * (sigmoid(w[0] * score + w[1]) - label)
        w -= adam.step(np.array([error @ score, error.sum()]) / weight.sum() + 1e-4 * w * [1, 0])
    return float(w[0]), float(w[1])
