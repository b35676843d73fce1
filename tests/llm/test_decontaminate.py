import itertools
import random
import re

import numpy as np

from coverlake.llm import decontaminate as d
from coverlake.llm.words import stretch


def tokens(text):
    return re.findall(r"[^\W_]+|[^\x00-\x7f]+", (text or "").lower()) if (text or "").isascii() else [
        w.decode() for w in d.words((text or "").encode())
    ]


def brute(docs, items):
    """Every diagonal of every pair."""
    out = {}
    for i, text in docs:
        own = tokens(text)
        for j, item in items:
            it = tokens(item)
            if len(it) < d.LEAST:
                continue
            for shift in range(-len(it) + 1, len(own)):
                low, high = max(0, -shift), min(len(it), len(own) - shift)
                same = [own[shift + k] == it[k] for k in range(low, high)]
                for a, b in itertools.combinations(range(len(same) + 1), 2):
                    if same[a] and same[b - 1] and sum(same[a:b]) >= d.SIMILAR * (b - a) and b - a >= min(d.WINDOW, len(it)):
                        out[i, j] = max(out.get((i, j), 0), b - a)
    return out


def test_masks_cover_two_replaced_words():
    for gone in itertools.combinations(range(d.WINDOW), 2):
        assert any(
            all(o + k not in gone for k, c in enumerate(m) if c == "1") for m in d.MASKS for o in range(d.WINDOW - len(m) + 1)
        )


def test_stretch_equals_enumeration():
    rng = np.random.default_rng(2)
    for _ in range(300):
        same = rng.random(rng.integers(0, 25)) < rng.choice([0.3, 0.7, 0.9])
        best = 0
        for a, b in itertools.combinations(range(len(same) + 1), 2):
            if same[a] and same[b - 1] and same[a:b].sum() >= d.SIMILAR * (b - a):
                best = max(best, b - a)
        a, b = stretch(same, d.SIMILAR)
        assert b - a == best and (best == 0 or (same[a] and same[b - 1]))


def test_overlaps_equal_brute_force(rows):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([5, 9, 13, 20, 31])))) for k in range(12)]
    items += [(50, None), (51, ""), (52, "too short"), (3, items[3][1])]
    docs = [(1, None), (2, ""), (None, "w1 w2 " + items[4][1])]
    for k in range(40):
        item = items[k % 12][1].split()
        start = rng.randrange(0, max(1, len(item) - 13))
        passage = item[start : start + rng.choice([13, 40])]
        for gone in rng.sample(range(len(passage)), rng.choice([0, 1, 2]) if len(passage) >= 13 else 0):
            passage[gone] = "other"
        noise = lambda: rng.choices(vocabulary, k=rng.randrange(0, 60))
        words = [*noise(), *passage, *noise()]
        docs.append((100 + k, rng.choice([" ", ", ", ".\n"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    docs += [docs[5], (7, "clean text without any passage at all " * 30)]
    got = d.overlaps(
        rows("doc_id long, text string, item_id string, seed string", [(*x, "q", "r") for x in docs]),
        rows("item_id long, text string, doc_id string", [(*x, "q") for x in items]),
    ).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id): r.doc_to - r.doc_from for r in got} == want
    assert len(got) == len(want) and len(want) >= 40
    by_id = dict(docs)
    for r in got:
        own, item = tokens(by_id[r.doc_id])[r.doc_from : r.doc_to], tokens(dict(items)[r.item_id])[r.item_from : r.item_to]
        assert len(own) == len(item) and sum(a == b for a, b in zip(own, item)) == r.matched and r.item_words == len(tokens(dict(items)[r.item_id]))


def test_empty_tables(rows):
    none = rows("doc_id long, text string", [])
    items = rows("item_id long, text string", [(1, "one two three four five six")])
    assert d.overlaps(none, items).collect() == []
    assert d.overlaps(rows("doc_id long, text string", [(1, "a b")]), rows("item_id long, text string", [])).collect() == []


def test_replaced_ends_do_not_hide_an_item(rows):
    sizes = (8, 12, 13, 14, 20)
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in sizes]
    docs, want = [], {}
    for n, item in items:
        for k, gone in enumerate([(0,), (n - 1,), (0, n - 1)]):
            words = [w if at not in gone else "other" for at, w in enumerate(item.split())]
            start = 0 if n != 20 else 7 if k else 0  # of the longest only thirteen words
            words = words[start : start + 13] if n == 20 else words
            equal = sum(w != "other" for w in words)
            docs.append((100 * n + k, " ".join(["before"] * 9 + words + ["after"] * 9)))
            if equal >= d.SIMILAR * min(len(words), d.WINDOW):
                want[100 * n + k, n] = equal
    got = d.overlaps(rows("doc_id long, text string", docs), rows("item_id long, text string", items), ends=True).collect()
    assert {(r.doc_id, r.item_id): r.matched for r in got} == want and len(want) == 14  # 6 of 8 words are too few
    texts, by_id = dict(docs), dict(items)
    for r in got:
        own, item = texts[r.doc_id].split()[r.doc_from : r.doc_to], by_id[r.item_id].split()[r.item_from : r.item_to]
        assert len(own) == len(item) >= min(13, r.item_words) and sum(a == b for a, b in zip(own, item)) == r.matched
