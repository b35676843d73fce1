"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is good or bad. The score of a line's state is linear in features of the line and of its two
neighbours; a 2 x 2 table scores neighbouring states. Forward-backward gives each line's chance of being good, and the
document's quality is the mean of these weighted by line length, put through a logistic curve fitted to the labels.

Only documents are labelled. Lines start with their document's label; then, twice, lines of bad documents that the
field finds good are relabelled, as long as half of the document's length stays bad, and the field is learned again.
It is learned on a bounded sample (``rows``); features and scores are computed in Spark over whole texts.

Defined cases: a null or empty text is one empty line; blank lines weigh nothing beside others; without both labels in the sample every score is
0.5; every input row gives one output row, repeated rows too; an empty table gives an empty result; further columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.common import held_out
from coverlake.llm.training import FOLDS, HELD_OUT, Adam, calibrate, sample, sigmoid
from coverlake.llm.words import spans, text_buffers

#: Labelled documents learned from at most.
ROWS = 6_000
THRESHOLD = 0.5
_BLOCK = 1 << 19
#: Classes of bytes counted in a line. Bytes above 127 count as letters.
CLASSES = ("upper", "lower", "digit", "space", "stop", "bang", "bar", "sign")
_CLASS = np.full(256, 7, np.uint8)
_CLASS[65:91] = 0
_CLASS[97:123] = 1
_CLASS[128:] = 1
_CLASS[48:58] = 2
_CLASS[[32, 9, 11, 12, 13]] = 3
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = 4
_CLASS[[ord(c) for c in "!?"]] = 5
_CLASS[ord("|")] = 6
OWN = 12
WIDTH = 3 * OWN + 1


def _rows_of_lines(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of lines and their text's number; every text has one line at least. ``cuts``: offsets of the texts."""
    breaks = np.flatnonzero(data == 10) + 1
    texts = len(cuts) - 1
    owner = np.searchsorted(cuts, breaks, "right") - 1  # a break at the very end of a text opens no line
    real = (owner < texts) & (breaks != cuts[np.clip(owner, 0, texts)])
    starts = np.concatenate([cuts[:-1], breaks[real]])
    owners = np.concatenate([np.arange(texts), owner[real]])
    order = np.lexsort((starts, owners))
    return starts[order], owners[order]


def line_features(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of some texts, their lengths without white space, and their text's number."""
    starts, owner = _rows_of_lines(data, cuts)
    ends = np.append(starts[1:], len(data))
    kinds = _CLASS[data]
    counts = np.empty((len(starts), len(CLASSES)))
    for k in range(len(CLASSES)):
        total = np.concatenate([[0], np.cumsum(kinds == k)])
        counts[:, k] = total[ends] - total[starts]
    counts[:, 7] -= [int(e > s and data[e - 1] == 10) for s, e in zip(starts, ends)]  # the line break itself
    size = ends - starts
    ink = np.maximum(0, counts.sum(1) - counts[:, 3])
    letters = counts[:, 0] + counts[:, 1]
    words, again, distinct = _repetition(data, starts, cuts)
    safe = np.maximum(ink, 1)
    own = np.column_stack([
        np.log1p(ink) / 5,
        counts[:, 0] / np.maximum(letters, 1),
        counts[:, 2] / safe,
        np.minimum(1, 4 * counts[:, 4] / safe),
        np.minimum(1, 10 * counts[:, 5] / safe),
        np.minimum(1, 10 * counts[:, 6] / safe),
        np.minimum(1, 5 * counts[:, 7] / safe),
        np.minimum(2, ink / np.maximum(words, 1) / 8),
        again / np.maximum(words, 1),
        1 - distinct / np.maximum(words, 1),
        (words < 4).astype(float),
        (ink == 0).astype(float),
    ])
    same_before = np.concatenate([[False], owner[1:] == owner[:-1]])
    before = np.where(same_before[:, None], np.vstack([own[:1], own[:-1]]), 0)
    after = np.where(np.append(same_before[1:], False)[:, None], np.vstack([own[1:], own[-1:]]), 0)
    return np.column_stack([own, before, after, np.ones(len(own))]), np.where(size > 0, ink, 0), owner


def _repetition(data: np.ndarray, starts: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line: words, words equal to the one before, and distinct words."""
    n = len(starts)
    begin, _, value = spans(data, cuts)
    line = np.searchsorted(starts, begin, "right") - 1  # of equal starts the last: an empty text has no word
    again = (value[1:] == value[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((value, line))
    v, ln = value[order], line[order]
    fresh = np.ones(len(v), bool)
    fresh[1:] = (v[1:] != v[:-1]) | (ln[1:] != ln[:-1])
    return np.bincount(line, minlength=n), np.bincount(line[1:][again], minlength=n), np.bincount(ln[fresh], minlength=n)


def marginals(emission: np.ndarray, owner: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of state 1 of each line, and the expected number of each pair of neighbouring states.

    ``emission``: score of state 1 against 0, per line; lines of one text are neighbours. Texts go side by side, longest
    first, one line at a time.
    """
    n = len(emission)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if n else np.zeros(0, int)
    size = np.diff(np.append(first, n))
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    score = np.column_stack([np.zeros(n), emission])
    forward, backward = np.empty((n, 2)), np.zeros((n, 2))
    steps = int(size[0]) if n else 0
    active = [int(np.searchsorted(-size, -t, "left")) for t in range(steps + 1)]  # texts with more than t lines
    for t in range(steps):
        at = first[: active[t]] + t
        if t == 0:
            forward[at] = score[at]
        else:
            reach = forward[at - 1][:, :, None] + table
            forward[at] = score[at] + np.logaddexp(reach[:, 0], reach[:, 1])
    expected = np.zeros((2, 2))
    for t in range(steps - 2, -1, -1):
        at = first[: active[t + 1]] + t
        reach = table + (score[at + 1] + backward[at + 1])[:, None, :]
        backward[at] = np.logaddexp(reach[:, :, 0], reach[:, :, 1])
        pair = forward[at][:, :, None] + reach
        pair -= np.logaddexp(np.logaddexp(pair[:, 0, 0], pair[:, 0, 1]), np.logaddexp(pair[:, 1, 0], pair[:, 1, 1]))[:, None, None]
        expected += np.exp(pair).sum(0)
    both = forward + backward
    return sigmoid(both[:, 1] - both[:, 0]), expected


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    table: np.ndarray
    slope: float
    shift: float


def learn_field(x: np.ndarray, owner: np.ndarray, y: np.ndarray, each: np.ndarray, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Weights and state table of the field that make the line labels ``y`` likeliest. ``each``: weight of a line."""
    w, adam = np.zeros(WIDTH + 4), Adam(WIDTH + 4, 0.1)
    joint = owner[1:] == owner[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][joint], y[1:][joint]), 1)
    for _ in range(rounds):
        p, expected = marginals(x @ w[:WIDTH], owner, w[WIDTH:].reshape(2, 2))
        slope = np.concatenate([x.T @ (each * (y - p)), (seen - expected).ravel()]) / len(y) - 1e-4 * w
        w += adam.step(slope)
    return w[:WIDTH], w[WIDTH:].reshape(2, 2)


def document_means(p: np.ndarray, length: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Mean chance of good lines per text, weighted by length (lines of equal weight where all are blank)."""
    total = np.bincount(owner, length, texts)
    length = np.where(total[owner] > 0, length, 1)
    return np.bincount(owner, p * length, texts) / np.bincount(owner, length, texts)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from at most ``rows`` labelled documents outside the held-out fold."""
    labelled, weight = sample(docs, labels, label, rows, id_col, text_col)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, x, length, owner in _blocks(batch.column("text")):
                ends = np.searchsorted(owner, np.arange(stop - first + 1))
                packed = np.column_stack([length, x]).astype("<f4")
                each = [packed[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("label").slice(first, stop - first), pa.array(each, pa.binary())], names=["label", "lines"])

    got = labelled.mapInArrow(lines, "label int, lines binary").collect()  # lines of at most ``rows`` documents
    label_of = np.array([r.label for r in got], int)
    if len(set(label_of)) < 2:
        return Model(np.zeros(WIDTH), np.zeros((2, 2)), 1.0, -0.5)
    each = [np.frombuffer(r.lines, "<f4").reshape(-1, WIDTH + 1) for r in got]
    owner = np.repeat(np.arange(len(each)), [len(e) for e in each])
    packed = np.concatenate(each).astype(float)
    length, x = packed[:, 0], packed[:, 1:]
    doc_weight = np.where(label_of == 0, weight, 1.0)
    y = label_of[owner]
    # lines count alike whatever the length of their document
    spread = 1 / np.bincount(owner)[owner] ** 0.5
    for again in range(3):
        w, table = learn_field(x, owner, y, spread / spread.mean())
        p, _ = marginals(x @ w, owner, table)
        if again < 2:
            y = _relabel(p, length, owner, label_of)
    slope, shift = calibrate(document_means(p, length, owner, len(each)), label_of, doc_weight)
    return Model(w, table, slope, shift)


def _relabel(p: np.ndarray, length: np.ndarray, owner: np.ndarray, label_of: np.ndarray) -> np.ndarray:
    """Lines of bad documents that look good become good, the likeliest first, up to half of the document's length."""
    order = np.lexsort((-p, owner))
    total = np.cumsum(length[order])
    first = np.searchsorted(owner[order], np.arange(len(label_of)))
    within = total - np.concatenate([[0], total])[first][owner[order]]
    whole = np.bincount(owner, length, len(label_of))
    good = np.empty(len(p), int)
    good[order] = (p[order] > 0.5) & (within <= whole[owner[order]] / 2)
    return np.where(label_of[owner] == 1, 1, good)


def _blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of whole texts with the features of their lines."""
    data, offsets = text_buffers(column)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _BLOCK, "right")) - 1)
        low = int(offsets[row])
        yield row, stop, *line_features(data[low : int(offsets[stop])], offsets[row : stop + 1] - low)
        row = stop


def _scores(column: pa.Array, model: Model) -> np.ndarray:
    out = np.empty(len(column))
    for first, stop, x, length, owner in _blocks(column):
        p, _ = marginals(x @ model.weights, owner, model.table)
        out[first:stop] = document_means(p, length, owner, stop - first)
    return sigmoid(model.slope * out + model.shift)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of every row. The model is some forty numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(batch.column("text"), model))], names=["doc_id", "score"])

    base = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return base.mapInArrow(run, "doc_id long, score double")


def good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, whose score reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(text_col), model) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``."""
    model = fit(docs, labels, label, rows, id_col, text_col)
    return score(docs, model, id_col, text_col).select(
        "doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
