import random

import xxhash

from coverlake.llm import common, simhash


def brute_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\x0b", " ").split(" ")]
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", " ".join(words))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(data, distance=2):
    prints = [brute_print(t or "") for _, t in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                root[find(i)] = find(j)
    out = []
    for i, (k, _) in enumerate(data):
        ids = [data[j][0] for j in range(len(data)) if find(j) == find(i) and data[j][0] is not None]
        out.append((k, f"{prints[i]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def test_groups_equal_brute_force(rows):
    rng = random.Random(3)
    vocabulary = [f"w{k}É" for k in range(300)] + ["THE", "Über"]
    data = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "One two"), (5, "one TWO"), (None, "one\ntwo"), (None, "lonely text here now")]
    for k in range(12):
        words = rng.choices(vocabulary, k=400)
        for copy in range(6):
            data.append((100 + 10 * k + copy, rng.choice([" ", "\n", "  "]).join(words)))
            words[rng.randrange(400)] = "x"
    df = rows("doc_id long, text string, print string, component_id string", [(*d, "q", "r") for d in data])
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_groups(df).collect()), key=str)
    want = brute(data)
    assert got == want
    assert len({w[2] for w in want}) < len(want) - 20


def test_every_close_pair_is_found(rows):
    rng = random.Random(4)
    prints = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        prints |= {base ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(5))}) for _ in range(6)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = rows("print long", signed)
    for distance, segments in ((1, 2), (2, 2), (3, 2), (3, 4), (2, 3)):
        want = {tuple(sorted((a[0], b[0]))) for a in signed for b in signed if a < b and bin((a[0] ^ b[0]) & (2**64 - 1)).count("1") <= distance}
        got = simhash.links(df, distance, segments).collect()
        assert len(got) == len(want) and {(r.a, r.b) for r in got} == want


def test_components_of_chains_and_stars(rows):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (500, 499), (500, 501), (499, 501)]
    got = {r.node: r.root for r in common.components(rows("a long, b long", edges)).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}, 499: 499, 500: 499, 501: 499}


def test_empty_table(rows):
    assert simhash.simhash_groups(rows("doc_id long, text string", [])).collect() == []
