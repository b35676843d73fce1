import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from coverlake.llm import ngram_lm as lm


def brute(data):
    """The same model with dictionaries of words."""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + ["</s>"]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in data]
    single, pair = Counter(), Counter()
    for (_, t), h in zip(data, held):
        if not h:
            w = split(t)
            single.update(w)
            pair.update(zip(["<s>", *w], w))
    before, after = Counter(w for _, w in pair), defaultdict(list)
    for (v, _), c in pair.items():
        after[v].append(c)

    def discounts(values):
        n = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        if min(n) == 0:
            return [0, 0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) for k in (1, 2, 3)]

    d2, d1 = discounts(list(pair.values())), discounts(list(before.values()))
    total, size = sum(single.values()), len(single)
    left = sum(d1[min(a, 3)] for a in before.values()) / max(len(pair), 1) if pair else 1.0

    def p1(w):
        a = before[w]
        return (max(a - d1[min(a, 3)], 0) / len(pair) if pair else 0) + left / (size + 1)

    def p2(v, w):
        c, all_of = pair[v, w], sum(after[v]) if v in after else 0
        if not all_of:
            return p1(w)
        return max(c - d2[min(c, 3)], 0) / all_of + sum(d2[min(x, 3)] for x in after[v]) / all_of * p1(w)

    out = []
    for (i, t), h in zip(data, held):
        w = split(t)
        base = sum(math.log10((single[x] + 0.1) / (total + 0.1 * (size + 1))) for x in w)
        value = sum(math.log10(p2(v, x)) for v, x in zip(["<s>", *w], w))
        out.append((i, h, len(w), sum(single[x] > 0 for x in w), total, round(base, 6), round(value, 6)))
    if pair:
        for v in list(after)[:3]:
            assert abs(sum(p2(v, w) for w in single) + left / (size + 1) * (1 - 0) * sum(d2[min(x, 3)] for x in after[v]) / sum(after[v]) - 1) < 1e-9
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [1 << 30, 2000])
def test_scores_equal_brute_force(rows, width, monkeypatch):
    monkeypatch.setattr(lm, "_FLUSH", 500)
    rng = random.Random(8)
    vocabulary = [f"W{k}é" for k in range(150)]
    data = [(k, " ".join(vocabulary[min(int(rng.expovariate(0.03)), 149)] for _ in range(rng.randrange(0, 80))) + rng.choice(["", "\n", f" rare{k}"])) for k in range(120)]
    data += [(500, None), (501, ""), (502, " \t"), (None, "w1é W2é"), data[4], data[4], (503, "never seen words here")] + [(600 + k, "w0é w0é " * 40) for k in range(9)]
    df = rows("doc_id long, text string, score string, keys string", [(*d, "q", "r") for d in data])
    got = lm.lm_scores(df, width=width).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got), key=str) == brute(data)


def test_pairs_hash_one_to_one():
    first, second = np.array([0, 5, 2**32 - 1, 77]), np.array([3, 0, 2**32 - 1, 2**31])
    back = lm.pair_of(lm.pair_key(first, second))
    assert back[0].tolist() == first.tolist() and back[1].tolist() == second.tolist()


def test_packing():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64))
    assert np.array_equal(lm.unpack(lm.pack(values), 1000), values)
    assert len(lm.unpack(lm.pack(values[:0]), 0)) == 0


def test_empty_and_untrained(rows):
    assert lm.lm_scores(rows("doc_id long, text string", [])).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    (r,) = lm.lm_scores(rows("doc_id long, text string", [(held, "a b")])).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0) and round(r.score, 6) == 0


def test_files_of_many_ranges_stay_open_from_block_to_block(tmp_path, monkeypatch):
    """As many ranges as some 12 GB of text have: the lookup of a second block opens no file again."""
    bits = 11
    keys = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    for k, key in enumerate(keys):
        for column in ("keys", "count", "context"):
            np.save(f"{tmp_path}/words-{column}-{k}.npy", np.full((1, 5) if column == "context" else 1, key if column == "keys" else k + 1))
    store = lm.Store(str(tmp_path), "words", bits, tuple(range(len(keys) + 1)))
    opened, load = [], np.load
    monkeypatch.setattr(np, "load", lambda path, **how: opened.append(path) or load(path, **how))
    for _ in range(2):
        number, found = store.find(keys, {"count": np.int64, "context": np.int64})
        assert number.tolist() == list(range(len(keys))) and found["count"].tolist() == [k + 1 for k in range(len(keys))]
    assert len(opened) == len(set(opened)) == 3 * len(keys)
