"""Phrase collocations from count streams in prefix and in suffix order.

Texts become streams of word numbers, in which a break ends each piece. Every task sorts the phrases of its block and
sends each distinct one once; Spark adds the counts up. Phrases of three words and more are counted only where both
phrases of one word less may be frequent, which a bit map of bounded size tells without missing one.

The frequent phrases are then laid out twice as sorted streams, ranges of which are merged independently. In prefix order
(words from the first on) a phrase follows its own beginnings, in suffix order (words from the last on) its own endings:
one lockstep pass that holds the open beginnings only yields the counts of all left parts and of the most frequent
extension to the right, the second pass those of the right parts and the extension to the left. Nothing is looked up by a
hash, and a pass holds as many rows as a phrase has words. A range keeps the phrases of one first (last) word together:
they are distinct frequent phrases, not occurrences, and pass by one at a time.

A part of a candidate is at least as frequent as the candidate, so the frequent phrases hold every part. A candidate
that lies in a much longer frequent one lies in one that is a word longer and at least as frequent, so extensions by one
word decide.

Defined cases: a null text is empty, a null language is ``und``; a text of any length is read in slices; repeated rows
count as often as they come; ties go to the shortest first part and to the smaller phrase; languages without a candidate
give no row, an empty table an empty result; further columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from coverlake.llm.common import stored
from coverlake.llm.words import runs

#: Bytes that end a piece, and bytes between words.
BREAKS, GAPS = b".,;:!?\n\v\f\r", b" \t"
LEAST, LONGEST, TOP = 10, 3, 2000
#: A candidate goes if a longer one has this share of its occurrences, in percent.
CONTAINED = 50
SCALE = 1_000_000
#: Words held by a task before their phrases are sent; bytes of a text read at a time; bits of the map.
_WORDS, _SLICE = 1 << 21, 1 << 20
_LEAST_BITS, _MOST_BITS = 16, 27
_TO = bytes.maketrans(bytes(range(65, 91)) + BREAKS + b"\t", bytes(range(97, 123)) + b"\n" * len(BREAKS) + b" ")
_PARTS = re.compile(rb"[^ \n]+|\n")
_EDGE = re.compile(rb"[ \n]")
_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])


# -- counting


class _Numbers(dict):
    """Numbers of words in the order they come; 0 is a break."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _slices(text: str) -> Iterator[bytes]:
    """Lower-cased bytes of a text, cut where a word ends."""
    raw, low = text.encode(), 0
    while len(raw) - low > _SLICE:
        part = raw[low : low + _SLICE].translate(_TO)
        rest = raw[low + _SLICE : low + 2 * _SLICE].translate(_TO)
        high, at = low + _SLICE, _EDGE.search(rest)
        while at is None and rest:  # a word that goes on
            part, high = part + rest, high + len(rest)
            rest = raw[high : high + _SLICE].translate(_TO)
            at = _EDGE.search(rest)
        cut = at.start() if at else 0
        yield part + rest[:cut]
        low = high + cut
    yield raw[low:].translate(_TO)


def _starts(ids: np.ndarray, n: int, fresh: int) -> np.ndarray:
    """Places where ``n`` words in a row begin whose last is at ``fresh`` or after it."""
    size = len(ids) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    whole = np.ones(size, bool)
    for k in range(n):
        whole &= ids[k : k + size] > 0
    whole[: max(0, fresh - n + 1)] = False
    return np.flatnonzero(whole)


def _distinct(ids: np.ndarray, at: np.ndarray, n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Words (a column for each place) of the distinct phrases of ``n`` words that begin at ``at``, and how often each comes.

    Phrases are sorted as numbers: the place of what comes before among its like, then the next word.
    """
    if n == 1:
        count = np.bincount(ids[at])
        seen = np.flatnonzero(count)
        return [seen], count[seen]
    shorter: list[np.ndarray] = []
    code = ids[at].astype(np.int64)
    for k in range(1, n):
        code <<= 32
        code |= ids[at + k]
        if k < n - 1:
            shorter.append(np.unique(code))
            code = np.searchsorted(shorter[-1], code)
    code.sort()
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    count, code = np.diff(np.append(first, len(code))), code[first]
    columns = [code & 0xFFFFFFFF]
    for known in reversed(shorter):
        code = known[code >> 32]
        columns.append(code & 0xFFFFFFFF)
    return [code >> 32, *reversed(columns)], count


@dataclass
class _Block:
    """Word numbers by language; of a text that goes on, the last words are carried over."""

    keep: int
    numbers: _Numbers = field(default_factory=lambda: _Numbers({b"\n": 0}))
    held: dict[str, list[np.ndarray]] = field(default_factory=dict)
    fresh: dict[str, int] = field(default_factory=dict)
    size: int = 0

    def add(self, lang: str, part: bytes) -> None:
        tokens = _PARTS.findall(part)
        if len(tokens) > 1:  # one call looks up all of them
            self.held.setdefault(lang, []).append(np.array(itemgetter(*tokens)(self.numbers), np.int32))
        elif tokens:
            self.held.setdefault(lang, []).append(np.array([self.numbers[tokens[0]]], np.int32))
        self.size += len(tokens)

    def end(self, lang: str) -> None:
        self.held.setdefault(lang, []).append(np.zeros(1, np.int32))

    def streams(self) -> Iterator[tuple[str, np.ndarray, int]]:
        for lang, parts in self.held.items():
            yield lang, np.concatenate(parts), self.fresh.get(lang, 0)

    def after(self, lang: str) -> _Block:
        """A new block that goes on in the text of ``lang``."""
        new = _Block(self.keep)
        parts = self.held.get(lang)
        if parts and self.keep:
            last = np.concatenate(parts)[-self.keep :]
            words = list(self.numbers)
            new.held[lang] = [np.array([new.numbers[words[k]] for k in last.tolist()], np.int32)]
            new.fresh[lang] = len(last)
        return new


def _counter(orders: list[int], allowed: Callable | None):
    """Counts phrases of the lengths ``orders``; with order 1 also all words, as the phrase of no word."""

    def send(block: _Block) -> Iterator[pa.RecordBatch]:
        words = pa.array(list(block.numbers), pa.binary()).cast(pa.string())
        hashes = np.array([xxh64_intdigest(w) for w in block.numbers], np.uint64) if allowed else None
        for lang, ids, fresh in block.streams():
            for n in orders:
                at = _starts(ids, n, fresh)
                if allowed is not None:
                    may = allowed(lang, hashes[ids], n - 1)
                    at = at[may[at] & may[at + 1]]
                if not len(at):
                    continue
                found, count = _distinct(ids, at, n)
                if n == 1:
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([""]), pa.array([len(at)], pa.int64())], schema=_COUNTED)
                for low in range(0, len(count), 1 << 16):
                    some = slice(low, low + (1 << 16))
                    columns = [words.take(pa.array(c[some])) for c in found]
                    phrase = pc.binary_join_element_wise(*columns, " ") if n > 1 else columns[0]
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(phrase)), phrase, pa.array(count[some])], schema=_COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(max(orders) - 1)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                for part in _slices(text.as_py()):
                    block.add(lang, part)
                    if block.size > _WORDS:
                        yield from send(block)
                        block = block.after(lang)
                block.end(lang)
        yield from send(block)

    return run


def _marks(phrases: list[str], langs: list[str]) -> np.ndarray:
    """A 64-bit value of each phrase, the one that :func:`_allowed` looks for."""
    out = [runs(np.array([xxh64_intdigest(w.encode()) for w in p.split(" ")], np.uint64), p.count(" ") + 1, xxh64_intdigest(g))[0] for p, g in zip(phrases, langs)]
    return np.array(out, np.uint64)


def frequent_map(grams: DataFrame) -> tuple[np.ndarray, int]:
    """A bit map of phrases (``lang``, ``phrase``) of 2**bits bits, at most 16 MB; it only spares work."""
    bits = min(_MOST_BITS, max(_LEAST_BITS, int(grams.count() * 8).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bit = _marks(batch.column("phrase").to_pylist(), batch.column("lang").to_pylist()) & np.uint64((1 << bits) - 1)
            value = (np.uint64(1) << (bit & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((bit >> np.uint64(6)).astype(np.int64)), pa.array(value)], names=["at", "bit"])

    marked = grams.select("lang", "phrase").mapInArrow(mark, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << bits - 6, np.int64)
    out[marked.column("at").to_numpy()] = marked.column("bit").to_numpy()
    return out.view(np.uint8), bits


def _allowed(sent, bits: int):
    def look(lang: str, hashes: np.ndarray, n: int) -> np.ndarray:
        found = runs(hashes, n, xxh64_intdigest(lang)) & np.uint64((1 << bits) - 1)
        return (sent.value[found >> np.uint64(3)] >> (found & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    return look


def counted(texts: DataFrame, orders: list[int], least: int, allowed: Callable | None = None) -> DataFrame:
    """``lang``, ``phrase``, ``f`` of phrases that come ``least`` times, and of the empty phrase: all words."""
    parts = texts.mapInArrow(_counter(orders, allowed), "lang string, phrase string, f long")
    sums = parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return stored(sums.filter((F.col("f") >= least) | (F.col("phrase") == "")))


def frequent(texts: DataFrame, longest: int, least: int) -> DataFrame:
    """All phrases of one to ``longest`` words that come ``least`` times."""
    found = last = counted(texts, [1, 2], least)
    for n in range(3, longest + 1):
        shorter = last.filter(F.size(F.split("phrase", " ")) == n - 1)
        bits, width = frequent_map(shorter)
        last = counted(texts, [n], least, _allowed(texts.sparkSession.sparkContext.broadcast(bits), width))
        found = found.union(last)
    return found


# -- streams


def _lockstep(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(row, counts of its beginnings from the shortest on, count of its most frequent extension by a word).

    ``rows`` are (lang, words, f, ...) in order; the open ones are the beginnings of the last.
    """
    open_: list[list] = []
    for row in rows:
        lang, words, f = row[:3]
        while open_ and not (open_[-1][0][0] == lang and words[: len(open_[-1][0][1])] == open_[-1][0][1]):
            yield tuple(open_.pop())
        if open_:
            open_[-1][2] = max(open_[-1][2], f)
        open_.append([row, [o[0][2] for o in open_], 0])
    while open_:
        yield tuple(open_.pop())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1 << 13) -> Iterator[pa.RecordBatch]:
    some = []
    for row in rows:
        some.append(row)
        if len(some) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def _ordered(stream: DataFrame) -> DataFrame:
    """Ranges of (language, first word) in the order of their words."""
    return stream.repartitionByRange("lang", F.col("words")[0]).sortWithinPartitions("lang", "words")


def candidates(grams: DataFrame, contained: int = CONTAINED) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r``, ``score`` of phrases of two words and more that no longer one contains."""
    lefts = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("f", pa.int64()), ("parts", pa.list_(pa.int64())), ("longer", pa.int64())])
    scored = pa.schema([("lang", pa.string()), ("phrase", pa.string()), *((n, pa.int64()) for n in ("a", "l", "r", "score"))])

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((row[0], row[1][::-1], row[2], parts, longer) for row, parts, longer in _lockstep(_rows(batches)))
        yield from _batches(found, lefts)

    def scores(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (lang, words, a, firsts, longer), lasts, other in _lockstep(rows):
            if len(words) > 1 and 100 * max(longer, other) < contained * a:
                value, k = min((SCALE * a * a // (x * y), k) for k, (x, y) in enumerate(zip(firsts, lasts[::-1])))
                yield lang, " ".join(words[::-1]), a, firsts[k], lasts[-1 - k], value

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(scores(_rows(batches)), scored)

    stream = grams.select("lang", F.split("phrase", " ").alias("words"), "f")
    reversed_ = _ordered(stream).mapInArrow(left, "lang string, words array<string>, f long, parts array<long>, longer long")
    return _ordered(reversed_).mapInArrow(right, "lang string, phrase string, a long, l long, r long, score long")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST, top: int = TOP, contained: int = CONTAINED
) -> DataFrame:
    """The first ``top`` candidates of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    texts = docs.select(F.coalesce(docs[lang_col], F.lit("und")).alias("lang"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    grams = frequent(texts, longest, least)
    totals = grams.filter("phrase = ''").select(F.col("lang").alias("of_lang"), F.col("f").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = candidates(grams.filter("phrase <> ''"), contained).withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, F.col("lang") == F.col("of_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
