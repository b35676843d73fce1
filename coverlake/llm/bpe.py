"""Byte-level BPE encoding and decoding, with tree concatenation for text that cannot be split.

A text is cut into pre-tokens by the vocabulary's pattern, and each pre-token is merged by rank. A pre-token above
``LEAF`` bytes is encoded in halves. The halves are joined by encoding a window of a few tokens around the join anew;
while the window's first or last token differs from what the half had there, the window doubles. A token sequence is
the encoding of its bytes exactly if each neighbouring pair is, so the result is exact once both ends agree.

A text above ``huge`` characters is dealt out in parts to different tasks. Parts end where the pattern always ends a
pre-token (before white space, or where letters, digits and other signs meet), or, where there is no such place, inside
a run of one kind of sign; the parts' tokens are then joined pairwise in a tree by the same windows.

Special tokens are matched in the text first, as the vocabulary's library does by default. Decoding joins the tokens'
bytes and replaces what is not UTF-8.

Defined cases: a null text is an empty one and has no token; a null id stays null; every input row gives one output
row, repeated rows too; an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache, lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How the vocabulary splits text before merging; fixed by the file format's "ByteLevel" rule.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
LEAF = 256
HUGE = 1 << 22
#: Chunks whose tokens a worker remembers; it starts afresh beyond, which changes no result.
REMEMBERED = 150_000
#: Lengths in bytes up to which pre-tokens are merged side by side, and how many at a time.
WIDTHS = (8, 16, 32, 64)
_MERGED = 4_000
_ROWS = 256
_NONE = 1 << 60


def byte_signs() -> list[str]:
    """The sign that stands for each byte in the file: itself if printable, else the next free sign from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


def token_bytes(file: dict) -> list[bytes]:
    """The bytes of every token by its id."""
    of_sign = {s: b for b, s in enumerate(byte_signs())}
    texts = {k: bytes(map(of_sign.__getitem__, sign)) for sign, k in file["model"]["vocab"].items()}
    texts |= {t["id"]: t["content"].encode() for t in file["added_tokens"]}
    return [texts.get(k, b"") for k in range(max(texts) + 1)]


def decoded(tokens: list[bytes], ids: bytes) -> str:
    """The text of packed ids; what is not UTF-8 is replaced."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


class Vocabulary:
    """Merges, tokens and special tokens of a byte-level BPE file."""

    def __init__(self, source: str) -> None:
        file = json.loads(source)
        ids: dict[str, int] = file["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = token_bytes(file)
        self.bytes = [ids[s] for s in byte_signs()]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(file["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[a], ids[b]] = rank, ids[a + b]
        self.pattern = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.known: dict[str, bytes] = {}
        self._byte_ids = np.array(self.bytes, np.int64)
        pairs = sorted((a << 32 | b, rank, made) for (a, b), (rank, made) in self.merges.items())
        self._keys, self._ranks, self._made = (np.array([p[k] for p in pairs] + [last], np.int64) for k, last in ((0, -1), (1, _NONE), (2, 0)))
        self._keys[-1] = np.iinfo(np.int64).max

    # -- merging

    def merge(self, raw: bytes) -> list[int]:
        """Tokens of one pre-token: the lowest rank first, the leftmost of equals."""
        if len(raw) > LEAF:
            return self._merge_long([self.bytes[b] for b in raw])
        ids = [self.bytes[b] for b in raw]
        get, none = self.merges.get, (_NONE, 0)
        found = [get(p, none) for p in zip(ids, ids[1:])]
        while found:
            low = min(found)
            if low is none or low[0] == _NONE:
                break
            i = found.index(low)
            ids[i : i + 2] = [low[1]]
            del found[i]
            if i:
                found[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(found):
                found[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for a window that had to grow."""
        n, get = len(ids), self.merges.get
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := get((ids[i], ids[i + 1])))]
        heapify(heap)
        while heap:
            _, i, a, b, made = heappop(heap)
            j = right[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], right[i] = made, -1, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for k in (left[i], i):
                if k >= 0 and right[k] >= 0 and (m := get((ids[k], ids[right[k]]))):
                    heappush(heap, (m[0], k, ids[k], ids[right[k]], m[1]))
        return [t for t in ids if t >= 0]

    def tree(self, raw: bytes) -> list[int]:
        """Tokens of a pre-token of any length, by halves."""
        if len(raw) <= LEAF:
            return self.merge(raw)
        half = len(raw) // 2
        return self.join(self.tree(raw[:half]), self.tree(raw[half:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of two encoded neighbours that belong to one pre-token."""
        k, tokens = 4, self.tokens
        while True:
            a, b = left[-k:], right[:k]
            window = self.merge(b"".join([tokens[t] for t in a + b]))
            if (k >= len(left) or window[0] == a[0]) and (k >= len(right) or window[-1] == b[-1]):
                return left[: len(left) - len(a)] + window + right[len(b) :]
            k *= 2

    def merge_many(self, raws: list[bytes], width: int) -> list[bytes]:
        """Packed tokens of many pre-tokens of at most ``width`` bytes: each round merges the best pair of every one.

        Rows hold the tokens between two empty columns; a merged token leaves a gap, which neighbours skip.
        """
        n, wide = len(raws), width + 2
        ids = np.full((n, wide), -1, np.int64)
        size = np.fromiter(map(len, raws), np.int64, n)
        grid = np.frombuffer(b"".join([r.ljust(width, b"\0") for r in raws]), np.uint8).reshape(n, width)
        ids[:, 1:-1] = np.where(np.arange(width) < size[:, None], self._byte_ids[grid], -1)
        ranks = np.full((n, wide), _NONE, np.int64)
        made = np.zeros((n, wide), np.int64)
        ranks[:, :-1], made[:, :-1] = self._look(ids[:, :-1], ids[:, 1:])
        after = np.broadcast_to(np.arange(1, wide + 1), (n, wide)).copy()
        before = np.broadcast_to(np.arange(-1, wide - 1), (n, wide)).copy()
        live = np.arange(n)
        while len(live):
            at = ranks[live].argmin(1)
            go = ranks[live, at] < _NONE
            live, at = live[go], at[go]
            gone = after[live, at]
            follow, lead = after[live, gone], before[live, at]
            ids[live, at], ids[live, gone] = made[live, at], -1
            after[live, at], before[live, follow] = follow, at
            ranks[live, gone] = _NONE
            ranks[live, at], made[live, at] = self._look(ids[live, at], ids[live, follow])
            ranks[live, lead], made[live, lead] = self._look(ids[live, lead], ids[live, at])
        packed = ids[ids >= 0].astype("<u4").tobytes()
        ends = np.cumsum((ids >= 0).sum(1)) * 4
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of pairs; an empty place (-1) merges with nothing."""
        key = np.where((a < 0) | (b < 0), 1 << 62, a << 32 | b)
        at = np.searchsorted(self._keys, key)
        hit = self._keys[at] == key
        return np.where(hit, self._ranks[at], _NONE), self._made[at]

    # -- texts

    def _learn(self, chunks: list[str]) -> None:
        """Remember the tokens of chunks, which hold whole pre-tokens."""
        split = [self._pre_tokens(c) for c in chunks]
        done: dict[bytes | int, bytes] = {k: k.to_bytes(4, "little") for k in self.special.values()}
        by_width: dict[int, list[bytes]] = {}
        for raw in {p for parts in split for p in parts} - done.keys():
            width = next((w for w in WIDTHS if len(raw) <= w), 0)
            by_width.setdefault(width, []).append(raw)
        for raw in by_width.pop(0, ()):
            done[raw] = np.array(self.tree(raw), "<u4").tobytes()
        for width, raws in by_width.items():
            for low in range(0, len(raws), _MERGED):
                done.update(zip(raws[low : low + _MERGED], self.merge_many(raws[low : low + _MERGED], width)))
        for chunk, parts in zip(chunks, split):
            self.known[chunk] = b"".join([done[p] for p in parts])

    def _pre_tokens(self, chunk: str) -> list[bytes | int]:
        """Bytes of each pre-token, and ids of special tokens."""
        if self.specials is None or not self.specials.search(chunk):
            return [p.encode() for p in self.pattern.findall(chunk)]
        out, at = [], 0
        for m in self.specials.finditer(chunk):
            out += [p.encode() for p in self.pattern.findall(chunk[at : m.start()])]
            out.append(self.special[m.group()])
            at = m.end()
        return out + [p.encode() for p in self.pattern.findall(chunk[at:])]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        find = _chunk().findall
        pieces = [find(t) for t in texts]
        new = set().union(*pieces).difference(self.known)
        if new:
            self._learn(list(new))
        of = self.known.__getitem__
        out = [b"".join(map(of, p)) for p in pieces]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> str:
        return decoded(self.tokens, ids)

    # -- parts of huge texts

    def parts(self, text: str, size: int) -> Iterator[tuple[str, bool]]:
        """Parts of about ``size`` characters, and whether the next part goes on inside the same pre-token."""
        low, n = 0, len(text)
        while n - low > size:
            at, inside = self._cut(text, low + size)
            if at >= n:
                break
            yield text[low:at], inside
            low = at
        yield text[low:], False

    def _cut(self, text: str, at: int) -> tuple[int, bool]:
        reach, step = max([16, *map(len, self.special)]), 4096
        while at < len(text):
            window = text[at : at + step]
            for kind, inside in ((_hard_cut(), False), (_run_cut(), True)):
                for m in kind.finditer(text, at, at + len(window)):
                    i = m.start()
                    if not any(s.start() < i - max(0, i - reach) < s.end() for s in self._near(text, i, reach)):
                        return i, inside
            at += len(window)
        return len(text), False

    def _near(self, text: str, i: int, reach: int):
        return self.specials.finditer(text[max(0, i - reach) : i + reach]) if self.specials else ()

    def edges(self, text: str) -> tuple[int, int, bool]:
        """Tokens of the first and of the last pre-token, and whether they are one."""
        if not text:
            return 0, 0, True
        head = self.pattern.match(text)
        first = len(self.tree(head.group().encode()))
        if head.end() == len(text):
            return first, first, True
        last = head
        for last in self.pattern.finditer(text, head.end()):
            pass
        return first, len(self.tree(last.group().encode())), False


@cache
def _chunk():
    """A run of white space and the run of other signs after it; the pattern always ends a pre-token between two of them."""
    white = "".join(c for c in map(chr, range(0x3001)) if regex.match(r"\p{White_Space}", c))
    return re.compile(f"[{white}]*[^{white}]+|[{white}]+")


@cache
def _hard_cut():
    """Places where the pattern always ends a pre-token."""
    sign = r"[^\p{White_Space}\p{L}\p{N}]"
    return regex.compile(
        rf"(?<=\P{{White_Space}})(?=\p{{White_Space}})|(?<=\p{{L}})(?=\p{{N}})|(?<=\p{{N}})(?=\p{{L}})|(?<=[\p{{L}}\p{{N}}])(?={sign})"
    )


@cache
def _run_cut():
    """Places well inside a run of one kind, where both sides are cut from one pre-token."""
    kinds = (r"\p{L}", r"\p{N}", r"\p{White_Space}", r"[^\p{White_Space}\p{L}\p{N}']")
    return regex.compile("|".join(rf"(?<={k}{{4}})(?={k}{{4}})" for k in kinds))


@lru_cache(maxsize=2)
def vocabulary(source: str) -> Vocabulary:
    return Vocabulary(source)


@lru_cache(maxsize=2)
def tokens_of(source: str) -> list[bytes]:
    """All that decoding needs: a worker that decodes holds no merges."""
    return token_bytes(json.loads(source))


def _shared(df: DataFrame, path: str):
    """The vocabulary file, read by the driver and sent to the workers."""
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, _ROWS):
            yield batch.slice(low, _ROWS)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", huge: int = HUGE) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers as one binary value) of every row."""
    source = _shared(docs, path)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(source.value)
        for batch in _slices(batches):
            ids = voc.encode_many(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(source.value)
        for batch in batches:
            for row, doc, text in zip(*(batch.column(n).to_pylist() for n in ("row", "doc_id", "text"))):
                for k, (part, inside) in enumerate(voc.parts(text, huge)):
                    yield pa.RecordBatch.from_pydict({"row": [row], "doc_id": [doc], "part": [k], "inside": [inside], "text": [part]}, schema=PARTS)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(source.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            edges = [voc.edges(t) for t in texts]
            made = {"ids": voc.encode_many(texts), "first": [e[0] for e in edges], "last": [e[1] for e in edges], "single": [e[2] for e in edges]}
            kept = {n: batch.column(n) for n in ("row", "doc_id", "part", "inside")}
            yield pa.RecordBatch.from_pydict(kept | made, schema=CODED)

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        voc = vocabulary(source.value)
        frame = frame.sort_values("part")
        nodes = [Node(*x) for x in zip(frame["ids"], frame["inside"], frame["first"], frame["last"], frame["single"])]
        while len(nodes) > 1:
            nodes = [nodes[k].followed(nodes[k + 1], voc) if k + 1 < len(nodes) else nodes[k] for k in range(0, len(nodes), 2)]
        return pd.DataFrame({"doc_id": frame["doc_id"].iloc[:1].astype("Int64"), "ids": [nodes[0].ids]})

    base = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    small = base.filter(F.length("text") <= huge).mapInArrow(whole, "doc_id long, ids binary")
    large = base.filter(F.length("text") > huge).withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text")
    coded = large.mapInArrow(split, SPARK_PARTS).repartition("row", "part").mapInArrow(part, SPARK_CODED)
    return small.union(coded.groupBy("row").applyInPandas(together, "doc_id long, ids binary"))


SPARK_PARTS = "row long, doc_id long, part long, inside boolean, text string"
SPARK_CODED = "row long, doc_id long, part long, inside boolean, ids binary, first long, last long, single boolean"
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
PARTS, CODED = (pa.schema([(n, _ARROW[t]) for n, t in map(str.split, s.split(", "))]) for s in (SPARK_PARTS, SPARK_CODED))


class Node:
    """Tokens of neighbouring parts; ``inside``: the text after them goes on in their last pre-token."""

    def __init__(self, ids: bytes, inside: bool, first: int, last: int, single: bool) -> None:
        self.ids, self.inside, self.first, self.last, self.single = ids, inside, first, last, single

    def followed(self, other: Node, voc: Vocabulary) -> Node:
        if not self.inside:
            return Node(self.ids + other.ids, other.inside, self.first, other.last, False)
        left, right = (np.frombuffer(x.ids, "<u4").tolist() for x in (self, other))
        at = len(left) - self.last
        joint = voc.join(left[at:], right[: other.first])
        ids = np.array(left[:at] + joint + right[other.first :], "<u4").tobytes()
        first = len(joint) if self.single else self.first
        last = len(joint) if other.single else other.last
        return Node(ids, other.inside, first, last, self.single and other.single)


def decode(coded: DataFrame, path: str, *keep: str) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``, to the columns ``keep`` and ``ids``."""
    source = _shared(coded, path)
    columns = [*keep, "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(source.value)
        for batch in _slices(batches):
            texts = [decoded(tokens, x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in columns), pa.array(texts, pa.string())], names=[*columns, "decoded"])

    schema = ", ".join(f"`{n}` {coded.schema[n].dataType.simpleString()}" for n in columns)
    return coded.select(*columns).mapInArrow(run, schema + ", decoded string")


def digests() -> list[Column]:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` from ``ids`` and ``decoded``."""
    return [
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    ]
