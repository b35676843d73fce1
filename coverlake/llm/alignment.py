"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenizers cut the same bytes into tokens A and B. Their token ends are two sorted streams; merging them gives every
overlap of an A token with a B token (each distinct end closes one), and every end that both have closes a group. The
merge of n + m ends is divided by diagonals: on diagonal d a binary search finds how many of the first d ends are A's.
Neighbouring diagonals bound pieces of equal work, whatever the shapes of the tokens, that need nothing of each other but
the end before them and one token after them. A piece emits its overlaps and the places where groups close; a group that
crosses pieces is stitched from the places of both.

The texts of a batch are one stream, since a text's end closes a group. A text of more than ``huge`` ends is sent in
pieces to different tasks and stitched by its row. How often each pair of ids is linked is summed per task, then in Spark;
the sums are written as sorted arrays, at most |A| x |B| of them whatever the corpus, which workers memory-map to look up
the pairs of each document. The highest sum of each B id is an array of |B| numbers.

Defined cases: a null or empty text, and one whose joined A or B bytes differ from space + text, has no tokens: zeros and
an empty ``groups_sha256``; special strings in a text are plain text; a null id stays null; ties for the highest count
are all best; every input row gives one output row, and repeated rows count as often as they come; an empty table gives an
empty result; a text of any length is tokenized whole, in one task; further columns are not looked at. The shared
folder must be mounted by the workers.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from coverlake.llm.bpe import PATTERN, Vocabulary, token_bytes
from coverlake.llm.common import stored
from coverlake.llm.ngram_lm import add_up, pack, unpack
from coverlake.session import shared_dir

#: Ends to merge in one piece, and above which a text's pieces go to different tasks.
PIECE = 1 << 16
HUGE = 1 << 20
#: Rows and characters tokenized at a time, pairs summed in a task before they are sent, files of the sums.
ROWS, CHARS = 128, 1 << 20
_PAIRS = 1 << 21
FILES = 64
_DONE = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs long, pairs binary, times binary"
_CODED = f"row long, piece int, part binary, {_DONE}"
_LONG = pa.int64()


# -- the merge


def diagonals(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of ``a`` and of ``b`` lie before each cut: every ``size`` steps of the merge, its start and its end.

    Of equal ends that of ``a`` comes first. All binary searches run side by side.
    """
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, size), total)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        right = a[mid] <= b[d[open_] - 1 - mid]
        low[open_] = np.where(right, mid + 1, low[open_])
        high[open_] = np.where(right, high[open_], mid)
    return low, d - low


@dataclass
class Piece:
    """Ends ``a`` and ``b`` between two diagonals, their ids with one more token each, and A's end before them."""

    a_ids: np.ndarray
    a: np.ndarray
    b_ids: np.ndarray
    b: np.ndarray
    before: int

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (B id, A id in one number) and ends of the overlaps, and how many ends of A and B lie before each closed group's end."""
        partner = np.searchsorted(self.b, self.a, "left")
        owner = np.searchsorted(self.a, self.b, "right")
        last = np.concatenate([[self.before], self.a])[owner]
        closed = last == self.b
        other = np.flatnonzero(~closed)
        ids_a = np.concatenate([self.a_ids[: len(self.a)], self.a_ids[owner[other]]])
        ids_b = np.concatenate([self.b_ids[partner], self.b_ids[other]])
        pairs = ids_b.astype(np.int64) << 32 | ids_a
        at = np.flatnonzero(closed)
        return pairs, np.concatenate([self.a, self.b[other]]), owner[at], at + 1


def pieces(a_ids: np.ndarray, a: np.ndarray, b_ids: np.ndarray, b: np.ndarray, size: int) -> Iterator[tuple[int, int, Piece]]:
    """(ends of A before, ends of B before, piece) of a whole stream."""
    i, j = diagonals(a, b, size)
    for k in range(len(i) - 1):
        before = int(a[i[k] - 1]) if i[k] else 0
        yield int(i[k]), int(j[k]), Piece(a_ids[i[k] : i[k + 1] + 1], a[i[k] : i[k + 1]], b_ids[j[k] : j[k + 1] + 1], b[j[k] : j[k + 1]], before)


# -- tokenizers


def by_rank(a_file: str) -> bool:
    """Whether merging the neighbours whose joint token has the lowest number gives the file's own tokens.

    It does if numbers follow the order of the merges, every byte has a token and the file's merges turn the bytes of each
    token into that token: two neighbours that make a token then are the pair that its merge names, since the merges
    inside them are those that its own bytes go through.
    """
    voc = Vocabulary(a_file)
    special = set(voc.special.values())
    made = [number for _, number in sorted(voc.merges.values())]
    whole = all(voc.merge(t) == [k] for k, t in enumerate(voc.tokens) if k not in special)
    return made == sorted(made) and whole and len({voc.tokens[k] for k in voc.bytes}) == 256


class Tokens:
    """Both tokenizers, and the bytes and lengths of their tokens. ``ranked``: see :func:`by_rank`."""

    def __init__(self, a_file: str, b_model: bytes, ranked: bool) -> None:
        file = json.loads(a_file)
        self.a_bytes = token_bytes(file)
        if ranked:
            special = {t["id"] for t in file["added_tokens"]}
            ranks = {t: k for k, t in enumerate(self.a_bytes) if k not in special}
            self.ranks = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            self.ranks = None
            self.a = Tokenizer.from_str(a_file)
            self.a.encode_special_tokens = True
            self.a.no_truncation()
            self.a.no_padding()
        self.b = SentencePieceProcessor(model_proto=b_model)
        self.b_bytes = [self._piece(k) for k in range(self.b.get_piece_size())]
        self.a_length, self.b_length = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        width = max(len(self.a_bytes), len(self.b_bytes))
        self.width = width
        self.written = [f"{k}{sign}" for sign in ",|;" for k in range(width)]

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both tokenizers for each text; None: no tokens."""
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(texts)
        at = [k for k, t in enumerate(texts) if t]
        coded = self._first([f" {texts[k]}" for k in at])
        other = self.b.encode([texts[k] for k in at], num_threads=1)
        for k, x, y in zip(at, coded, other):
            whole, y = f" {texts[k]}".encode(), np.array(y, np.int64)
            if _bytes(x, self.a_bytes) == whole and _bytes(y, self.b_bytes) == whole:
                out[k] = x, y
        return out

    def _first(self, texts: list[str]) -> list[np.ndarray]:
        """A's ids of each text, special strings being plain text."""
        if self.ranks is not None:
            return [self.ranks.encode_to_numpy(t, disallowed_special=()).astype(np.int64) for t in texts]
        return [np.array(c.ids, np.int64) for c in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def groups(self, a_ids: np.ndarray, b_ids: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[str]:
        """Every token in the order of the groups, written with the sign after it."""
        side_a = np.repeat(np.arange(len(cut_a)), np.diff(cut_a, prepend=0))
        side_b = np.repeat(np.arange(len(cut_b)), np.diff(cut_b, prepend=0))
        codes = np.empty(len(a_ids) + len(b_ids), np.int64)
        sign_a, sign_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
        sign_a[cut_a - 1], sign_b[cut_b - 1] = 1, 2
        codes[np.arange(len(a_ids)) + np.concatenate([[0], cut_b])[side_a]] = a_ids + sign_a * self.width
        codes[np.arange(len(b_ids)) + cut_a[side_b]] = b_ids + sign_b * self.width
        return list(map(self.written.__getitem__, codes.tolist()))


def _bytes(ids: np.ndarray, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=1)
def _tokens(a_file: str, b_model: bytes, ranked: bool) -> Tokens:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokens(a_file, b_model, ranked)


def _digest(written: list[str]) -> str:
    return hashlib.sha256("".join(written)[:-1].encode()).hexdigest()


def _folded(pairs: np.ndarray) -> tuple[int, bytes, bytes]:
    """Distinct pairs and how often each comes, packed."""
    keys, times = np.unique(pairs, return_counts=True)
    return len(keys), pack(keys), pack(times)


# -- documents


def _small(texts: list[str], tokens: Tokens, coded: list, size: int) -> Iterator[tuple]:
    """(n_a, n_b, n_groups, n_links, groups_sha256, n_pairs, pairs, times) of each text, merged as one stream."""
    full = [c for c in coded if c is not None]
    if full:
        n_a, n_b = (np.array([len(c[side]) for c in full]) for side in (0, 1))
        a_ids, b_ids = (np.concatenate([c[side] for c in full]) for side in (0, 1))
        a, b = np.cumsum(tokens.a_length[a_ids]), np.cumsum(tokens.b_length[b_ids])
        found = [(i, j, *p.merged()) for i, j, p in pieces(a_ids, a, b_ids, b, size)]
        pairs, ends = (np.concatenate([f[k] for f in found]) for k in (2, 3))
        cut_a, cut_b = np.concatenate([f[0] + f[4] for f in found]), np.concatenate([f[1] + f[5] for f in found])
        written = tokens.groups(a_ids, b_ids, cut_a, cut_b)
        last = np.cumsum(n_a)
        doc_of_link = np.searchsorted(a[last - 1], ends, "left")
        order = np.argsort(doc_of_link, kind="stable")
        pairs = pairs[order]
        links = np.bincount(doc_of_link, minlength=len(full))
        to_link, to_token = np.cumsum(links), np.cumsum(n_a + n_b)
        to_group = np.searchsorted(cut_a, last, "right")
        groups = np.diff(to_group, prepend=0)
    k = 0
    for c in coded:
        if c is None:
            yield 0, 0, 0, 0, "", 0, b"", b""
            continue
        of = slice(to_link[k] - links[k], to_link[k])
        said = _digest(written[to_token[k] - n_a[k] - n_b[k] : to_token[k]])
        yield int(n_a[k]), int(n_b[k]), int(groups[k]), int(links[k]), said, *_folded(pairs[of])
        k += 1


def _packed(start: tuple[int, int], piece: Piece) -> bytes:
    parts = (piece.a_ids, piece.a, piece.b_ids, piece.b)
    head = np.array([*start, piece.before, *map(len, parts)], np.int64)
    return np.concatenate([head, *parts]).astype("<i8").tobytes()


def _unpacked(blob: bytes) -> tuple[int, int, Piece]:
    values = np.frombuffer(blob, "<i8")
    i, j, before, *sizes = values[:7].tolist()
    a_ids, a, b_ids, b = np.split(values[7:], np.cumsum(sizes)[:3])
    return i, j, Piece(a_ids, a, b_ids, b, before)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """(rows, ids, texts) of bounded numbers of rows and characters."""
    for batch in batches:
        rows, docs = ([], [], []), 0
        for item in zip(*(batch.column(n).to_pylist() for n in ("row", "doc_id", "text"))):
            if rows[0] and (len(rows[0]) >= ROWS or docs + len(item[2]) > CHARS):
                yield rows
                rows, docs = ([], [], []), 0
            for column, value in zip(rows, item):
                column.append(value)
            docs += len(item[2])
        if rows[0]:
            yield rows


def coded_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, huge: int, size: int) -> DataFrame:
    """One finished row of each document; of a huge one a row for each piece instead."""
    with open(a_path, encoding="utf-8") as file_a, open(b_path, "rb") as file_b:
        a_file, b_model = file_a.read(), file_b.read()
    sent = docs.sparkSession.sparkContext.broadcast((a_file, b_model, by_rank(a_file)))
    schema = _arrow(_CODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(*sent.value)
        for rows, ids, texts in _batches(batches):
            coded = tokens.encode(texts)
            large = [c is not None and len(c[0]) + len(c[1]) > huge for c in coded]
            kept = [k for k, far in enumerate(large) if not far]
            done = _small([texts[k] for k in kept], tokens, [coded[k] for k in kept], size)
            out = [(rows[k], None, None, ids[k], *d) for k, d in zip(kept, done)]
            yield _batch(out, schema)
            for k in (k for k, far in enumerate(large) if far):
                a_ids, b_ids = coded[k]
                streams = pieces(a_ids, np.cumsum(tokens.a_length[a_ids]), b_ids, np.cumsum(tokens.b_length[b_ids]), size)
                for n, (i, j, piece) in enumerate(streams):
                    yield _batch([(rows[k], n, _packed((i, j), piece), ids[k], *[None] * 8)], schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc, n, blob in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "piece", "part"))):
                i, j, piece = _unpacked(blob)
                pairs, _, cut_a, cut_b = piece.merged()
                ids = (piece.a_ids[: len(piece.a)], piece.b_ids[: len(piece.b)])
                n_pairs, keys, times = _folded(pairs)
                item = [row, doc, n, *(np.asarray(x, "<i8").tobytes() for x in (*ids, i + cut_a, j + cut_b)), len(pairs), n_pairs, keys, times]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(item, _arrow(_MERGED))], schema=_arrow(_MERGED))

    def stitch(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("piece")
        a_ids, b_ids, cut_a, cut_b = (np.frombuffer(b"".join(frame[c]), "<i8") for c in ("a_ids", "b_ids", "cut_a", "cut_b"))
        written = _tokens(*sent.value).groups(a_ids, b_ids, cut_a, cut_b)
        keys, times = add_up(*(np.concatenate([unpack(x, n) for x, n in zip(frame[c], frame["n_pairs"])]) for c in ("pairs", "times")))
        item = (len(a_ids), len(b_ids), len(cut_a), int(frame["n_links"].sum()), _digest(written), len(keys), pack(keys), pack(times))
        names = [f.name for f in _arrow(_DONE)]
        out = pd.DataFrame([(None, *item)], columns=names)
        out["doc_id"] = frame["doc_id"].iloc[:1].astype("Int64").values
        return out

    base = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = base.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text")
    coded = stored(rows.mapInArrow(run, _CODED))
    columns = [f.name for f in _arrow(_DONE)]
    parts = coded.filter("piece IS NOT NULL").select("row", "doc_id", "piece", "part").repartition("row", "piece")
    whole = parts.mapInArrow(merge, _MERGED).groupBy("row").applyInPandas(stitch, _DONE)
    return coded.filter("piece IS NULL").select(*columns).union(stored(whole))


_MERGED = "row long, doc_id long, piece int, a_ids binary, b_ids binary, cut_a binary, cut_b binary, n_links long, n_pairs long, pairs binary, times binary"
_TYPES = {"long": _LONG, "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


@lru_cache(maxsize=8)
def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in map(str.split, schema.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# -- sums of pairs


def _joined(table: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and times of all documents of a batch, and each document's number of them."""
    sizes = table.column("n_pairs").to_numpy()
    packed = [(n, k, t) for n, k, t in zip(sizes.tolist(), table.column("pairs").to_pylist(), table.column("times").to_pylist()) if n]
    keys = [unpack(k, n).astype(np.int64) for n, k, _ in packed]
    times = [unpack(t, n).astype(np.int64) for n, _, t in packed]
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(keys or empty), np.concatenate(times or empty), sizes


def _part_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, links) summed over a task, or over as many pairs as it may hold."""
    held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            waiting.append(_joined(batch.slice(low, ROWS))[:2])
            if sum(len(k) for k, _ in waiting) > _PAIRS:
                held, waiting = add_up(*map(np.concatenate, zip(held, *waiting))), []
                if len(held[0]) > _PAIRS:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, held)), names=["pair", "links"])
                    held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    yield pa.RecordBatch.from_arrays(list(map(pa.array, add_up(*map(np.concatenate, zip(held, *waiting))))), names=["pair", "links"])


@dataclass(frozen=True)
class Sums:
    """Sorted pairs and their sums in files of the shared folder, and the highest sum of each B id."""

    files: tuple[tuple[int, str], ...]  # the first pair of each file, its path

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Sums of sorted pairs, all of which are stored."""
        out = np.zeros(len(keys), np.int64)
        edges = np.append(np.searchsorted(keys, [first for first, _ in self.files], "left"), len(keys))
        for (_, path), a, b in zip(self.files, edges, edges[1:]):
            if a < b:
                out[a:b] = _mapped(f"{path}.links")[np.searchsorted(_mapped(f"{path}.pairs"), keys[a:b])]
        return out


@lru_cache(maxsize=2 * FILES)
def _mapped(path: str) -> np.ndarray:
    return np.memmap(path, np.int64, "r")


def _place(spark: SparkSession) -> str:
    path = urlparse(shared_dir(spark))
    if path.scheme not in ("", "file"):
        raise ValueError("pair sums are memory-mapped: spark.checkpoint.dir must be a folder that workers have mounted")
    place = f"{path.path}/pair-sums-{uuid4().hex}"
    os.makedirs(place)
    return place


def pair_sums(done: DataFrame) -> tuple[Sums, DataFrame]:
    """Links of every pair of ids over all documents, as mapped files and as rows (``pair``, ``links``)."""
    place = _place(done.sparkSession)
    summed = done.select("n_pairs", "pairs", "times").mapInArrow(_part_sums, "pair long, links long").groupBy("pair").agg(F.sum("links").alias("links"))
    rows = stored(summed)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{place}/{TaskContext.get().partitionId()}"
        own = f"{path}.{uuid4().hex}"
        first = None
        with open(f"{own}.pairs", "wb") as pairs, open(f"{own}.links", "wb") as links:
            for batch in batches:
                if batch.num_rows:
                    first = batch.column("pair")[0].as_py() if first is None else first
                    batch.column("pair").to_numpy().tofile(pairs)
                    batch.column("links").to_numpy().tofile(links)
        for kind in ("pairs", "links"):
            os.replace(f"{own}.{kind}", f"{path}.{kind}")
        if first is not None:
            yield pa.RecordBatch.from_pydict({"first": [first], "path": [path]})

    made = rows.repartitionByRange(FILES, "pair").sortWithinPartitions("pair").mapInArrow(write, "first long, path string")
    return Sums(tuple(sorted((r.first, r.path) for r in made.collect()))), rows  # a row for each of at most FILES files


def aligned(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", huge: int = HUGE, size: int = PIECE
) -> DataFrame:
    """Counts and digest of the alignment of every row of ``docs``; ``a_path``: byte-level BPE, ``b_path``: sentencepiece."""
    done = coded_documents(docs, a_path, b_path, id_col, text_col, huge, size)
    sums, rows = pair_sums(done)
    best = np.zeros(0, np.int64)
    of_b = rows.groupBy(F.shiftright("pair", 32).alias("b")).agg(F.max("links").alias("links")).collect()  # a row for each B id at most
    if of_b:
        best = np.zeros(max(r.b for r in of_b) + 1, np.int64)
        best[[r.b for r in of_b]] = [r.links for r in of_b]
    sent = docs.sparkSession.sparkContext.broadcast((sums, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, best = sent.value
        kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                keys, times, sizes = _joined(part)
                distinct, place = np.unique(keys, return_inverse=True)
                count = sums.find(distinct)[place]
                highest = (count == best[keys >> 32]) if len(keys) else np.zeros(0, bool)
                of_doc = np.repeat(np.arange(len(sizes)), sizes)
                n_best, total = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
                np.add.at(n_best, of_doc, times * highest)
                np.add.at(total, of_doc, times * count)
                columns = [*(part.column(n) for n in kept), pa.array(n_best), pa.array(total), part.column("groups_sha256")]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_best", "count_sum", "groups_sha256"])

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return done.mapInArrow(run, schema)
