import hashlib
import random
import re

import pytest

from coverlake.llm import exact


def brute(data):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in data]
    out = []
    for k, (i, _) in enumerate(data):
        same = [j for j, t in enumerate(texts) if t == texts[k]]
        keep = min(same, key=lambda j: (data[j][0] is None, data[j][0] or 0, j))
        out.append((i, data[keep][0], len(same), hashlib.sha256(texts[k].encode()).hexdigest()))
    return sorted(out, key=str)


DATA = [
    (5, "a  b"), (3, "a\tb"), (9, "a b "), (3, "a b"), (None, "a b"), (1, None), (2, ""), (4, " \n"), (7, " "),
    (11, "x" * 300), (12, "x" * 300), (13, "x" * 299 + "y"), (14, "é " * 40), (15, "é " * 40), (None, "zz"), (None, "zz"),
]


@pytest.mark.parametrize("huge,chunk,prime", [(1 << 23, 1 << 16, exact.PRIME), (64, 16, exact.PRIME), (64, 16, 2), (1 << 23, 16, 1)])
def test_groups_equal_brute_force(rows, huge, chunk, prime):
    """Small parts, and moduli so small that different texts share fingerprints."""
    df = rows("doc_id long, text string, n_bytes string, h1 string", [(*d, "q", None) for d in DATA])
    got = exact.exact_duplicates(df, huge=huge, chunk=chunk, prime=prime).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(DATA)
    groups = {}
    for r in got:
        groups.setdefault(r.text_sha256, []).append(r)
    for members in groups.values():
        kept = [r for r in members if r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id


def test_parts_combine_to_the_hash_of_the_whole():
    raw = random.Random(1).randbytes(10_001)
    whole = exact.fingerprint(raw, chunk=1 << 16)
    for cut in (2, 128, 9_998, 10_000):
        a, b = exact.fingerprint(raw[:cut], chunk=64), exact.fingerprint(raw[cut:], chunk=64)
        assert [(a[k] * b[2 + k] + b[k]) % exact.PRIME for k in (0, 1)] == list(whole[:2])


def test_empty_table(rows):
    assert exact.exact_duplicates(rows("doc_id long, text string", [])).collect() == []
