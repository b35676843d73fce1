"""Collocations against counting every phrase in plain Python."""

import random
import re
from collections import Counter

import pytest

from coverlake.llm import phrases


def plain(docs, longest, least, top, contained=50):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    frequent = {g: c for g, c in f.items() if len(g[1]) > 1 and c >= least}
    out = []
    for (lang, words), a in frequent.items():
        inside = any(
            g[0] == lang and len(g[1]) > len(words) and 100 * c >= contained * a and any(g[1][i : i + len(words)] == words for i in range(len(g[1])))
            for g, c in frequent.items()
        )
        if inside:
            continue
        cuts = [(1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], n[lang], score))
    ranked = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        ranked += [(lang, rank, *o[1:]) for rank, o in enumerate(own[:top], 1)]
    return sorted(ranked)


def made(seed, size):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "a\x01b", "éte", "big", "apple", "x" * 30, "東京", " "]
    gaps = [" "] * 12 + ["  ", "\t", ", ", ". ", "\n", "\r\n", "?", " .. ", "\x0b"]
    return [
        (rng.choice(["en", "en", "en", "de", None]), "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(0, 60))))
        for _ in range(size)
    ] + [("en", None), ("fr", ""), (None, "new york city " * 20), ("en", "big apple " * 40), ("en", "big apple " * 40)]


@pytest.mark.parametrize(("longest", "least", "top"), [(2, 3, 50), (3, 3, 1000), (4, 2, 40)])
def test_collocations_equal_the_plain_count(spark, rows, longest, least, top):
    data = made(longest, 120)
    docs = rows("lang string, text string, phrase int, f string", [(*d, 1, "x") for d in data]).repartition(3)
    got = phrases.collocations(docs, longest=longest, least=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(data, longest, least, top)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 20


def test_small_blocks_and_slices_change_nothing():
    data = [("en", t) for _, t in made(9, 80) if t] + [("en", "one two three four " * 30 + "z" * 500 + " end one two")]

    def count(words, size):
        before = phrases._WORDS, phrases._SLICE
        phrases._WORDS, phrases._SLICE = words, size
        try:
            total = Counter()
            import pyarrow as pa

            batch = pa.RecordBatch.from_pydict({"lang": [d[0] for d in data], "text": [d[1] for d in data]})
            for out in phrases._counter([1, 2, 3], None)(iter([batch])):
                for lang, phrase, f in zip(*(c.to_pylist() for c in out.columns)):
                    total[lang, phrase] += f
            return total
        finally:
            phrases._WORDS, phrases._SLICE = before

    whole = count(1 << 22, 1 << 20)
    assert count(5, 16) == whole and count(50, 7) == whole and whole["en", "one two three"] > 20


def test_no_rows(spark, rows):
    assert phrases.collocations(rows("lang string, text string", [])).collect() == []
    assert phrases.collocations(rows("lang string, text string", [(None, None), ("en", "")])).collect() == []


def test_exact_beyond_64_bits(rows):
    """1000000 * a * a and l * r are near 10**25."""
    big = 3_000_000_007
    grams = [("a", 4 * big), ("b", 2 * big + 1), ("c", 5 * big), ("a b", big), ("b c", big + 2), ("a b c", big // 3)]
    got = phrases.candidates(rows("lang string, phrase string, f long", [("en", *g) for g in grams]))
    f = dict(grams)
    want = {
        ("en", p, f[p], f[l], f[r], 1_000_000 * f[p] ** 2 // (f[l] * f[r]))
        for p, l, r in [("a b", "a", "b"), ("b c", "b", "c"), ("a b c", "a b", "c")]
    }
    assert {tuple(r) for r in got.collect()} == want
