import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from coverlake.llm import quality, toxicity, training

TOXIC = "you are a stupid moron and scum "
CLEAN = "the river runs by the old mill and the fields "


def corpus(rows, make):
    docs, labels = [], []
    for i in range(240):
        text, q, t = make(i)
        docs.append((i, text, "x", 0.5))
        labels.append((i, q, t))
    docs += [(900, None, "x", 1.0), (901, "", "x", 1.0), (3, docs[3][1], "y", 2.0), (None, "no id", "z", 0.0)]
    labels += [(None, 1, 1), (5, None, None), (6, 0, 1), (6, 1, 0), (5000, 1, 1)]
    return rows("doc_id long, text string, label string, score double", docs), rows("doc_id long, quality int, toxic int", labels), docs


def test_toxicity_learns_and_holds_out(rows):
    df, labels, docs = corpus(rows, lambda i: (CLEAN * (1 + i % 5) + (TOXIC if i % 3 == 0 else "") + CLEAN * (i % 7), 1, int(i % 3 == 0)))
    got = toxicity.toxicity(df, labels).collect()
    assert len(got) == len(docs)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.doc_id is not None and r.doc_id < 900:
            assert r.predicted == int(r.doc_id % 3 == 0), r


def area(pairs):
    """Share of pairs of a toxic and another document in which the toxic one has the higher score, by ranks."""
    import pandas as pd

    frame = pd.DataFrame(pairs, columns=["score", "label"])
    rank, n = frame.score.rank(), frame.label.sum()
    return (rank[frame.label == 1].sum() - n * (n + 1) / 2) / (n * (len(frame) - n))


@pytest.mark.parametrize("scale, least, most_missed", [("sf0.01", 0.88, 0.5), ("sf0.1", 0.937, 0.25)])
def test_toxicity_holds_on_labels_it_did_not_learn_from(spark, scale, least, most_missed):
    """``least`` at sf0.1 is what plain log-odds of words reach on the same split."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{scale}/{name}.parquet") for name in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").where("toxic is not null").collect()
    assert area([(r.score, r.toxic) for r in got]) >= least
    toxic, clean = ([r.predicted for r in got if r.toxic == k] for k in (1, 0))
    assert 1 - sum(toxic) / len(toxic) < most_missed and sum(clean) / len(clean) < 0.01


def test_no_document_of_a_label_in_a_fold_or_in_the_sample(rows):
    """With one toxic document no n-gram tells; every score is the same."""
    docs = rows("doc_id long, text string", [(i, CLEAN + (TOXIC if i == 3 else "")) for i in range(40)])
    for toxic in ([3], [], list(range(40))):
        got = toxicity.toxicity(docs, rows("doc_id long, toxic int", [(i, int(i in toxic)) for i in range(40)])).collect()
        assert len(got) == 40 and len({r.score for r in got}) == 1 and 0 <= got[0].score <= 1


def test_quality_learns_and_holds_out(rows):
    junk = ["THE!! RIVER!! RUNS!! BY!!\n", "a$$$ b%%% c&&& d***\n", "the | river | runs |\n", "mill mill mill mill mill\n"]
    df, labels, docs = corpus(rows, lambda i: (CLEAN + ".\n" + (junk[i // 2 % 4] * 4 if i % 2 else (CLEAN + ".\n") * (1 + i % 6)), 1 - i % 2, 0))
    got = quality.quality(df, labels).collect()
    assert len(got) == len(docs)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None and r.doc_id < 900:
            assert r.predicted == 1 - r.doc_id % 2, r


def test_labels_of_the_held_out_fold_do_not_matter(rows):
    df, labels, _ = corpus(rows, lambda i: (CLEAN + (TOXIC if i % 3 == 0 else ""), 1, int(i % 3 == 0)))
    turned = rows(
        "doc_id long, toxic int",
        [(r.doc_id, 1 - r.toxic if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1 else r.toxic) for r in labels.collect()],
    )
    assert np.array_equal(toxicity.fit(df, labels).weights, toxicity.fit(df, turned).weights)


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality.quality])
def test_empty_tables(rows, operator):
    none = rows("doc_id long, quality int, toxic int", [])
    assert operator(rows("doc_id long, text string", []), none).collect() == []
    got = operator(rows("doc_id long, text string", [(1, "a b"), (2, None)]), none).collect()
    assert len(got) == 2 and all(0 <= r.score <= 1 for r in got)


def test_sample_is_bounded_and_balanced(rows):
    df, labels, _ = corpus(rows, lambda i: (CLEAN, 1, int(i % 3 == 0)))
    got, weight = training.sample(df, labels, "toxic", 40)
    counts = {k: sum(r.label == k for r in got.collect()) for k in (0, 1)}
    assert counts[0] >= 20 and counts[1] == 20 and 1.5 < weight < 2.5  # a repeated document may come twice


def test_ngrams_of_blocks_equal_those_of_the_whole(monkeypatch):
    texts = ["", "abc", TOXIC * 9, "É" * 30 + "the same old mill", CLEAN * 20, "x"]
    keep = np.zeros(toxicity.BUCKETS, bool)
    keep[::3] = True

    def sets():
        out = {}
        for first, stop, row, bucket in toxicity.features(pa.array(texts), keep):
            for r, b in zip(row.tolist(), bucket.tolist()):
                out.setdefault(r, set()).add(b)
        return out

    want = {}
    for k, text in enumerate(texts):
        raw = np.frombuffer(text.encode(), np.uint8)
        exact = set()
        for k_th, size in enumerate(toxicity.SIZES):
            for i in range(len(raw) - size + 1):  # each n-gram by itself
                exact.add(int(list(toxicity.grams(raw[i : i + size]))[k_th][0]))
        if kept := {b for b in exact if keep[b]}:
            want[k] = kept
    assert sets() == want
    monkeypatch.setattr(toxicity, "_BLOCK", 16)
    assert sets() == want


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    sizes = [1, 4, 2, 6, 1]
    owner = np.repeat(np.arange(5), sizes)
    emission, table = rng.normal(size=len(owner)), rng.normal(size=(2, 2))
    p, expected = quality.marginals(emission, owner, table)
    want_p, want_pairs = np.zeros(len(owner)), np.zeros((2, 2))
    for k, n in enumerate(sizes):
        at = np.flatnonzero(owner == k)
        weights = {}
        for states in itertools.product((0, 1), repeat=n):
            weights[states] = math.exp(sum(emission[at[i]] * s for i, s in enumerate(states)) + sum(table[a, b] for a, b in zip(states, states[1:])))
        total = sum(weights.values())
        for states, w in weights.items():
            want_p[at] += np.array(states) * w / total
            for a, b in zip(states, states[1:]):
                want_pairs[a, b] += w / total
    assert np.allclose(p, want_p) and np.allclose(expected, want_pairs)


def test_line_features_of_texts_end_to_end():
    texts = ["", "One two.\nTHREE FOUR!!\n", "\n\n", "a a a | b", "x\ny"]
    raw = [t.encode() for t in texts]
    cuts = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    x, length, owner = quality.line_features(np.frombuffer(b"".join(raw), np.uint8), cuts)
    assert np.bincount(owner, minlength=5).tolist() == [1, 2, 2, 1, 2]
    assert length.tolist() == [0, 7, 11, 0, 0, 5, 1, 1]
    alone = [quality.line_features(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0] for r in raw]
    assert np.allclose(x, np.concatenate(alone))
