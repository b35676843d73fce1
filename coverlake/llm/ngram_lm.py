"""Language-model scores from an interpolated modified Kneser-Ney bigram model, counted in Spark.

Words are hashed to 64 bits. The words of the training texts are counted per task and merged by range of their hash;
each range becomes a sorted hash array in the shared folder, and a word's place in the arrays is its number. Pairs of
neighbours get a one-to-one 64-bit hash of their two numbers, and are counted and stored the same way. Merging a range
of pairs also yields, per word, in how many different pairs it comes second, and the sum and the counts of counts of
the pairs in which it comes first. Workers memory-map the arrays and look up sorted keys block by block.

``p(w|v) = max(c(vw) - D(c), 0) / C(v) + g(v) p(w)`` with ``p(w) = max(a(w) - D'(a), 0) / A + g' / (V + 1)``: ``a`` is
the number of different words before ``w``, the three discounts of each order come from its counts of counts, ``g``
gives each order what the discounts took, and an unknown word has the share of one of V + 1 words.

Every stage holds blocks of bounded size; the number of ranges follows the input. The shared folder must be mounted by
the workers (``spark.checkpoint.dir``), since they map its files.

Defined cases: a null text is an empty one, with its end as only token; a null id is never held out; without training
texts every word is unknown; every input row gives one output row, repeated rows too, and repeated rows count as often
as they come; an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlake.llm.common import held_out, stored
from coverlake.llm.words import blocks, mix
from coverlake.session import shared_dir

FOLDS, HELD_OUT = 10, 0
#: The token that ends each text, and bytes of text for each range of keys.
END = np.uint64(0x1D8AF066C0FFEE11)
RANGE = 1 << 23
_FLUSH = 1 << 21
_BLOB = "shard long, n long, keys binary, counts binary"
_SCHEMA = pa.schema([("shard", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_ZSTD = pa.Codec("zstd", 1)


# -- packed arrays


def pack(values: np.ndarray) -> bytes:
    """Sorted or small 64-bit numbers, as compressed planes of the bytes of their differences."""
    steps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    return _ZSTD.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), asbytes=True)


def unpack(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(_ZSTD.decompress(blob, 8 * n, asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts (rows of ``counts``)."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first, axis=0) if len(first) else counts


def _save(path: str, array: np.ndarray) -> None:
    """Write under a name of its own, then move: a second try of a task does no harm."""
    own = f"{path}.{uuid4().hex}"
    with open(own, "wb") as file:
        np.save(file, array)
    os.replace(own, path)


# -- stored model


@dataclass(frozen=True)
class Store:
    """Sorted hash arrays of one order: range ``k`` has the hashes whose top bits are ``k``."""

    place: str
    name: str
    bits: int
    starts: tuple[int, ...]  # number of the first key of each range, and of all keys

    def array(self, column: str, k: int) -> np.ndarray:
        return _mapped(f"{self.place}/{self.name}-{column}-{k}.npy")

    def slices(self, keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(range, from, to) of sorted keys."""
        top = (keys >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)
        edges = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1], [True]])) if len(keys) else []
        for a, b in zip(edges, edges[1:]):
            if self.starts[top[a] + 1] > self.starts[top[a]]:
                yield int(top[a]), int(a), int(b)

    def find(self, keys: np.ndarray, columns: dict[str, np.dtype]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Numbers of sorted keys (-1: unknown) and what the columns have for them (else 0)."""
        number = np.full(len(keys), -1, np.int64)
        found = {c: np.zeros((len(keys), *([5] if c == "context" else [])), t) for c, t in columns.items()}
        for k, a, b in self.slices(keys):
            stored = self.array("keys", k)
            at = np.minimum(np.searchsorted(stored, keys[a:b]), len(stored) - 1)
            hit = np.flatnonzero(stored[at] == keys[a:b])
            number[a + hit] = self.starts[k] + at[hit]
            for c, out in found.items():
                out[a + hit] = self.array(c, k)[at[hit]]
        return number, found


#: Six files for each range of words and pairs, of all ranges one after the other in every block: if not all stay open, each is
#: opened anew for each block. Maps cost no memory of their own; the system allows some 65,000 a process.
_OPEN = 1 << 15


@lru_cache(maxsize=_OPEN)
def _mapped(path: str) -> np.ndarray:
    return np.load(path, mmap_mode="r")


@dataclass(frozen=True)
class Model:
    words: Store
    pairs: Store
    tokens: int
    opening: tuple[int, ...]  # what "context" has for the place before a text
    discounts: tuple[tuple[float, ...], tuple[float, ...]]
    distinct_pairs: int
    counts_of_counts: tuple[int, ...]  # words with one, two, three or more different words before them


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of keys seen once to four times."""
    if min(n) <= 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    return tuple(min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.0), float(k + 1)) for k in range(3))


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first.astype(np.uint64) << np.uint64(32) | second.astype(np.uint64))


def pair_of(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two numbers behind a pair's hash: ``mix`` undone."""
    x = key ^ (key >> np.uint64(31)) ^ (key >> np.uint64(62))
    x = x * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    x = x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))
    return (x >> np.uint64(32)).astype(np.int64), (x & np.uint64(0xFFFFFFFF)).astype(np.int64)


# -- counting


def token_blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first row, tokens per row, token hashes), the end token included."""
    for first, counts, hashes in blocks(column):
        ends = np.cumsum(counts + 1) - 1
        tokens = np.empty(len(hashes) + len(counts), np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[ends] = False
        tokens[inner], tokens[ends] = hashes, END
        yield first, counts + 1, tokens


def _emit(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One blob for each shard; ``shard`` is sorted like the keys."""
    edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(keys) else []
    rows = [(int(shard[a]), int(b - a), pack(keys[a:b]), pack(counts[a:b].ravel())) for a, b in zip(edges, edges[1:])]
    if rows:
        yield pa.RecordBatch.from_pydict(dict(zip(_SCHEMA.names, map(list, zip(*rows)))), schema=_SCHEMA)


def _counted(keys_of: Callable[[], Callable[[np.ndarray, np.ndarray], np.ndarray]], bits: int):
    """A task's keys, counted in bounded blocks and dealt to the ranges of the hash."""

    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        shard = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        yield from _emit(keys, counts.astype(np.uint64), shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, parts, held = keys_of(), [], 0
        for batch in batches:
            for _, counts, tokens in token_blocks(batch.column("text")):
                parts.append(make(tokens, counts))
                held += len(parts[-1])
                if held >= _FLUSH:
                    yield from flush(parts)
                    parts, held = [], 0
        if parts:
            yield from flush(parts)

    return run


def _merge(table: pa.Table, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rows = list(zip(*(table.column(c).to_pylist() for c in ("n", "keys", "counts"))))
    keys = np.concatenate([unpack(k, n) for n, k, _ in rows])
    counts = np.concatenate([unpack(c, n * width).reshape(-1, width) for n, _, c in rows]).astype(np.int64)
    return add_up(keys, counts)


def numbers(words: Store, tokens: np.ndarray, columns: dict) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Distinct tokens' place for each token, and what the store has for the distinct ones."""
    distinct, place = np.unique(tokens, return_inverse=True)
    return place, *words.find(distinct, columns)


def _before(number: np.ndarray, counts: np.ndarray, opening: int) -> np.ndarray:
    """The number before each token; a text's first has ``opening``."""
    out = np.empty_like(number)
    out[1:] = number[:-1]
    out[np.cumsum(counts) - counts] = opening
    return out


def _place(spark: SparkSession) -> str:
    path = urlparse(shared_dir(spark))
    if path.scheme not in ("", "file"):
        raise ValueError("the model is memory-mapped: spark.checkpoint.dir must be a folder that workers have mounted")
    place = f"{path.path}/ngram-lm-{uuid4().hex}"
    os.makedirs(place)
    return place


def _starts(sizes: dict[int, int], bits: int) -> tuple[int, ...]:
    return tuple(np.concatenate([[0], np.cumsum([sizes.get(k, 0) for k in range(1 << bits)])]).tolist())


def train(texts: DataFrame, width: int = RANGE) -> Model:
    """A model of the column ``text``; ``width``: bytes of text for each range of keys."""
    place = _place(texts.sparkSession)
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    bits = max(0, int(np.ceil(np.log2(max(1, size / width)))))

    def words_of():
        return lambda tokens, counts: tokens

    def store_words(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = _merge(table)
        _save(f"{place}/words-keys-{key[0]}.npy", keys)
        _save(f"{place}/words-count-{key[0]}.npy", counts[:, 0])
        return pa.table({"shard": [key[0].as_py()], "size": [len(keys)], "total": [int(counts.sum())]})

    counted = texts.mapInArrow(_counted(words_of, bits), _BLOB)
    done = counted.groupBy("shard").applyInArrow(store_words, "shard long, size long, total long").collect()  # a row for each range
    words = Store(place, "words", bits, _starts({r.shard: r.size for r in done}, bits))
    vocabulary = words.starts[-1]

    def pairs_of():
        def make(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
            at, number, _ = numbers(words, tokens, {})
            return pair_key(_before(number[at], counts, vocabulary), number[at])

        return make

    def store_pairs(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = _merge(table)
        count = counts[:, 0]
        _save(f"{place}/pairs-keys-{key[0]}.npy", keys)
        _save(f"{place}/pairs-count-{key[0]}.npy", np.minimum(count, 255).astype(np.uint8))
        _save(f"{place}/pairs-many-{key[0]}.npy", np.column_stack([np.flatnonzero(count >= 255), count[count >= 255]]))
        first, second = pair_of(keys)
        one = np.zeros((2 * len(keys), 5), np.int64)  # a, C, N1, N2, N3
        one[: len(keys), 0] = 1
        one[len(keys) :, 1] = count
        one[np.arange(len(keys), 2 * len(keys)), 1 + np.minimum(count, 3)] = 1
        ids, values = add_up(np.concatenate([second, first]).astype(np.uint64), one)
        of_count = [int((count == c).sum()) for c in (1, 2, 3, 4)]
        head = pa.RecordBatch.from_pydict({"shard": [-1], "n": [len(keys)], "keys": [b""], "counts": [np.array([key[0].as_py(), *of_count], "<i8").tobytes()]}, schema=_SCHEMA)
        shard = np.searchsorted(np.array(words.starts), ids, "right") - 1
        return pa.Table.from_batches([head, *_emit(ids, values.astype(np.uint64), shard)])

    got = stored(texts.mapInArrow(_counted(pairs_of, bits), _BLOB).groupBy("shard").applyInArrow(store_pairs, _BLOB))
    heads = [(r.n, np.frombuffer(r.counts, "<i8")) for r in got.filter("shard = -1").collect()]
    pairs = Store(place, "pairs", bits, _starts({int(h[0]): n for n, h in heads}, bits))
    of_pairs = np.sum([h[1:] for _, h in heads], axis=0).tolist() if heads else [0] * 4

    def store_contexts(key: tuple, table: pa.Table) -> pa.Table:
        ids, values = _merge(table, 5)
        k = key[0].as_py()
        opening = ids == vocabulary
        if k < len(words.starts) - 1:
            _save(f"{place}/words-context-{k}.npy", values[~opening])
        a = values[~opening, 0]
        state = [[int((a == c).sum()) for c in (1, 2, 3, 4)] + [int((a >= 3).sum())]]
        return pa.table({"opening": pa.array(values[opening].tolist(), pa.list_(pa.int64())).slice(0, 1) if opening.any() else pa.array([None], pa.list_(pa.int64())), "state": state})

    of_words = got.filter("shard >= 0").groupBy("shard").applyInArrow(store_contexts, "opening array<long>, state array<long>").collect()
    state = np.sum([r.state for r in of_words], axis=0).tolist() if of_words else [0] * 5
    opening = next((tuple(r.opening) for r in of_words if r.opening), (0,) * 5)
    return Model(
        words, pairs, sum(r.total for r in done), opening, (discounts(of_pairs), discounts(state[:4])), pairs.starts[-1], (state[0], state[1], state[4])
    )


# -- scoring


def _discounted(count: np.ndarray, d: tuple[float, ...]) -> np.ndarray:
    return np.maximum(count - np.array([0.0, *d])[np.minimum(count, 3)], 0)


def block_scores(model: Model, tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text of a block: known tokens, base score and model score."""
    vocabulary = model.words.starts[-1]
    at, number, found = numbers(model.words, tokens, {"count": np.int64, "context": np.int64})
    owner = np.repeat(np.arange(len(counts)), counts)
    base = np.log10((found["count"] + 0.1) / (model.tokens + 0.1 * (vocabulary + 1)))
    known = np.bincount(owner, found["count"][at] > 0, len(counts)).astype(np.int64)

    d2, d1 = model.discounts
    spread = float(np.dot(d1, model.counts_of_counts)) / model.distinct_pairs if model.distinct_pairs else 1.0
    single = _discounted(found["context"][:, 0], d1) / max(model.distinct_pairs, 1) + spread / (vocabulary + 1)

    context = found["context"]
    total = np.maximum(context[:, 1], 1)
    rest = np.where(context[:, 1] > 0, context[:, 2:] @ np.array(d2) / total, 1.0)
    o = model.opening
    previous = _before(at, counts, len(number))  # the place before a text comes after the distinct tokens
    total = np.append(total, max(o[1], 1))[previous]
    rest = np.append(rest, np.dot(o[2:], d2) / o[1] if o[1] else 1.0)[previous]

    first, second = np.append(number, vocabulary)[previous], number[at]
    seen = np.flatnonzero((first >= 0) & (second >= 0))
    keys, place = np.unique(pair_key(first[seen], second[seen]), return_inverse=True)
    pair = np.zeros(len(tokens), np.int64)
    pair[seen] = pair_counts(model.pairs, keys)[place]
    p = _discounted(pair, d2) / total + rest * single[at]
    return known, np.bincount(owner, base[at], len(counts)), np.bincount(owner, np.log10(p), len(counts))


def pair_counts(pairs: Store, keys: np.ndarray) -> np.ndarray:
    number, found = pairs.find(keys, {"count": np.int64})
    count = found["count"]
    for k, a, b in pairs.slices(keys):
        high = a + np.flatnonzero(count[a:b] == 255)
        if len(high):
            many = pairs.array("many", k)
            count[high] = many[np.searchsorted(many[:, 0], number[high] - pairs.starts[k]), 1]
    return count


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = RANGE) -> DataFrame:
    """Learn from the rows outside the held-out fold and score every row: ``doc_id``, ``held_out``, ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10) and ``perplexity``."""
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    model = train(base.filter(~held_out("doc_id", FOLDS, HELD_OUT)).select("text"), width)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, counts, tokens in token_blocks(batch.column("text")):
                known, plain, value = block_scores(sent.value, tokens, counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(counts)), *map(pa.array, (counts, known, plain, value))],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    scored = base.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id",
        held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
