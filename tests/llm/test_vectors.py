"""Near-duplicate vectors against all cosines."""

import numpy as np
import pytest

from coverlake.llm import vectors
from coverlake.llm.vectors import near_vectors

NAN, INF = float("nan"), float("inf")


def plain(data, link=0.9):
    """(vec_id, n_links, component_id, kept) of every row, from all pairs."""
    ok = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in data]
    links = [[] for _ in data]
    for a, (_, u) in enumerate(data):
        for b, (_, v) in enumerate(data):
            if a != b and ok[a] and ok[b] and len(u) == len(v):
                x, y = (np.float32(w).astype(float) for w in (u, v))
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= link:
                    links[a].append(b)
    return reach(data, links)


def reach(data, links):
    out, done = [None] * len(data), set()
    for a in range(len(data)):
        if a in done:
            continue
        group, todo = {a}, [a]
        while todo:
            todo += (new := set(links[todo.pop()]) - group)
            group |= new
        done |= group
        ids = [data[k][0] for k in group if data[k][0] is not None]
        least = min(ids, default=None)
        for k in group:
            out[k] = (data[k][0], len(links[k]), least, data[k][0] is not None and data[k][0] == least)
    return sorted(out, key=str)


def planted(rng, groups, noise, dim=24, alone=300):
    """Vectors of their own and groups of near copies whose noise varies."""
    parts = [rng.normal(size=(alone, dim))]
    for size in groups:
        base = rng.normal(size=dim)
        parts.append(base + rng.uniform(*noise, size=(size, 1)) * rng.normal(size=(size, dim)))
    x = np.concatenate(parts).astype(np.float32)
    return x[rng.permutation(len(x))]


def frame(rows, data):
    return rows("vec_id long, embedding array<float>, node string, cell int", [(i, v, "x", 1) for i, v in data]).repartition(3)


def result(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_small_table_is_compared_whole(spark, rows):
    x = planted(np.random.default_rng(1), [2, 3, 40], (0.05, 0.3))
    data = [(int(k), v.tolist()) for k, v in enumerate(x)]
    assert result(near_vectors(frame(rows, data), block=100)) == plain(data)


@pytest.mark.parametrize("leaf", [40, 120])
def test_cells_lose_no_link_of_a_group(spark, rows, leaf):
    x = planted(np.random.default_rng(2), [2] * 20 + [5] * 10 + [150], (0.02, 0.2), dim=48)
    data = [(int(k), v.tolist()) for k, v in enumerate(x)]
    got = result(near_vectors(frame(rows, data), leaf=leaf, part=25, block=32))
    assert got == plain(data)


def test_share_of_links_found_near_the_threshold(spark, rows):
    """Pairs spread evenly over cosines from 0.9 to 1, in cells far smaller than in use."""
    rng = np.random.default_rng(5)
    u = rng.normal(size=(600, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.normal(size=u.shape)
    w -= (w * u).sum(1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    c = rng.uniform(0.902, 0.999, size=(600, 1))
    x = np.concatenate([u, c * u + np.sqrt(1 - c * c) * w])
    data = [(int(k), v.tolist()) for k, v in enumerate(x.astype(np.float32))]
    got = result(near_vectors(frame(rows, data), leaf=100, part=60))
    want = plain(data)
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))


def test_edge_cases(spark, rows):
    one = [1.0, 2.0, 3.0]
    data = [
        (1, one), (2, one), (2, one), (3, [2.0, 4.0, 6.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [NAN, 1.0, 1.0]), (8, [INF, 1.0, 1.0]),
        (9, [None, 1.0, 1.0]), (10, [1.0, 2.0]), (None, one), (None, [-1.0, 0.0, 0.5]), (None, None), (11, [1e38, 2e38, 3e38]), (12, [-0.0, 1.0, 0.0]), (13, [0.0, 1.0, 0.0]),
        (0, [1.0, 2.1]),
    ]
    assert result(near_vectors(frame(rows, data))) == plain(data)
    assert result(near_vectors(frame(rows, []))) == []
    assert result(near_vectors(frame(rows, [(4, None)]))) == [(4, 0, 4, True)]


def test_doubles_and_threshold(spark, rows):
    at = [0.9, float(np.sqrt(1 - 0.81))]
    data = [(1, [1.0, 0.0]), (2, at), (3, [0.8999999, float(np.sqrt(1 - 0.8999999**2))])]
    got = result(near_vectors(rows("vec_id long, embedding array<double>", data)))
    assert got[0][1] in (0, 1) and got[2][1] == 1  # 3 links with 2 only; 1 and 2 are the threshold itself
    assert [r[0] for r in got] == [1, 2, 3]


def test_forest():
    rng = np.random.default_rng(0)
    for _ in range(30):
        n = int(rng.integers(2, 60))
        a, b = rng.integers(0, n, (2, int(rng.integers(0, 60))))
        label = vectors.forest(n, a, b)
        links = [[*b[a == k], *a[b == k]] for k in range(n)]
        want = {int(r[0]): int(r[2]) for r in reach([(k, 0) for k in range(n)], links)}
        assert {k: int(v) for k, v in enumerate(label)} == want
