"""The pipeline against a plain version of its stages, and its stages on awkward rows."""

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from test_simhash import brute_print
from tokenizers import Tokenizer

import corpus_pipeline
from coverlake.llm import decontaminate, quality, stages
from coverlake.llm.words import stretch

FOLDER = "/root/testdata/sf0.001"


def leaks(text, items):
    own = [w.decode() for w in decontaminate.words(text.encode())]
    at = {}
    for k, w in enumerate(own):
        at.setdefault(w, []).append(k)
    for item in items:
        it = [w.decode() for w in decontaminate.words(item.encode())]
        if len(it) < decontaminate.LEAST:
            continue
        least = min(decontaminate.WINDOW, len(it))
        for shift, n in Counter(k - p for p, w in enumerate(it) for k in at.get(w, ())).items():
            if n >= decontaminate.SIMILAR * least:
                same = np.array([0 <= shift + p < len(own) and own[shift + p] == w for p, w in enumerate(it)])
                a, b = stretch(same, decontaminate.SIMILAR)
                if b - a >= least:
                    return True
    return False


def plain(docs, good, items):
    docs = sorted((d for d in docs if d[0] in good), key=lambda d: d[0])
    seen, exact = set(), []
    for i, t in docs:
        n = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        if n not in seen:
            seen.add(n)
            exact.append((i, t))
    prints = [brute_print(t) for _, t in exact]
    root = list(range(len(exact)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(exact)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    near = [d for k, d in enumerate(exact) if find(k) == k]
    return near, [d for d in near if not leaks(d[1], items)], exact


def test_pipeline_equals_plain_stages(spark):
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{FOLDER}/documents.parquet'").fetchall()
    items = [r[0] for r in duckdb.sql(f"SELECT text FROM '{FOLDER}/benchmark.parquet'").fetchall()]
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in quality.quality(docs, labels).filter("predicted = 1").collect()}
    near, clean, exact = plain(rows, good, items)
    assert len(good) < len(rows) and len(exact) < len(good) and len(clean) < len(near)
    library = Tokenizer.from_file(stages.VOCABULARY)
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in got} == {i for i, _ in clean} and len(got) == len(clean)
    texts = dict(clean)
    for r in got:
        ids = np.array(library.encode(texts[r.doc_id], add_special_tokens=False).ids, "<u4").tobytes()
        assert bytes(r.ids) == ids and r.n_tokens == len(ids) // 4
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_stage_names():
    assert [f for _, f in corpus_pipeline.STAGES] == [
        stages.good_documents, stages.distinct_documents, stages.one_of_each_group, stages.without_benchmark, stages.encoded,
    ]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, text_hash long, ids string"


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_awkward_rows(spark, rows, name, stage):
    texts = [(1, "a b c"), (1, "a b c"), (1, "a  b c"), (2, "a b c"), (None, "a b c"), (None, None), (None, None), (3, None), (4, ""), (5, "the river runs " * 50), (5, "other text")]
    df = rows(SCHEMA, [(i, t, None, "s", None, None, None, 7, "x") for i, t in texts])
    got = stage(spark, df, FOLDER)
    n = got.count()
    if name == "encode":
        assert n == len(texts)
        return
    assert got.schema == df.schema
    if name == "exact":
        assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, next(r.text for r in got.collect() if r.doc_id == 1)), (3, None), (5, texts[9][1]), (5, "other text")], key=str)
    if name == "simhash":
        assert Counter(r.doc_id for r in got.collect()) == Counter({1: 2, 3: 1, 5: 2}) or Counter(r.doc_id for r in got.collect())[3] == 1
    if name == "decontaminate":
        assert n == len(texts)
    empty = stage(spark, rows(SCHEMA, []), FOLDER)
    assert empty.count() == 0 and empty.schema == df.schema
