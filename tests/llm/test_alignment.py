"""Alignment of two tokenizers against a token-by-token version."""

import hashlib
import json
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from coverlake.llm.alignment import Piece, Tokens, aligned, by_rank, diagonals, pieces
from coverlake.llm.bpe import byte_signs
from coverlake.llm.queries import op13_token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, sha) of each text, one token at a time."""
    hf, sp = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    hf.encode_special_tokens = True
    of_sign = {s: b for b, s in enumerate(byte_signs())}
    name = {k: s for s, k in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}
    out, links_of = [], []
    for text in texts:
        whole = f" {text or ''}".encode()
        a = hf.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        bytes_a = [bytes(of_sign[c] for c in name[k]) for k in a]
        bytes_b = [bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode() for k in b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            out.append((0, 0, 0, 0, "")), links_of.append([])
            continue
        spans = []
        for parts in (bytes_a, bytes_b):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            spans.append(list(zip([0, *ends[:-1]], ends)))
        links = [(x, y) for x, (l, r) in zip(a, spans[0]) for y, (m, s) in zip(b, spans[1]) if l < s and m < r]
        cuts = sorted({r for _, r in spans[0]} & {r for _, r in spans[1]})
        groups = []
        for low, high in zip([0, *cuts], cuts):
            sides = [",".join(str(k) for k, (l, r) in zip(ids, span) if low <= l and r <= high) for ids, span in zip((a, b), spans)]
            groups.append("|".join(sides))
        out.append((len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links_of.append(links)
    count = Counter(p for links in links_of for p in links)
    best = {}
    for (_, y), c in count.items():
        best[y] = max(best.get(y, 0), c)
    return [(*o[:4], sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), o[4]) for o, links in zip(out, links_of)]


TEXTS = [
    None, "", " ", "a", "The quick brown fox, isn't it?", "The quick brown fox, isn't it?", "  two  spaces\tand\n\nlines  ",
    "naïve café — übergrößen €5 東京都 🦊🦊", "<|endoftext|><s> </s> plain", "holds ▁ the mark", "x" * 300, "\x00\x01 control",
    "supercalifragilistic antidisestablishmentarianism " * 3, "1234567890 3.14159", " nbsp em", "ab" * 200 + " tail",
]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("huge", "size"), [(1 << 20, 1 << 16), (1 << 20, 7), (20, 7), (0, 1)])
def test_alignment_equals_the_plain_one(spark, rows, huge, size):
    data = [(k, t, "en", 1) for k, t in enumerate(TEXTS)] + [(None, "null id", "en", 1), (4, TEXTS[4], "en", 1)]
    docs = rows("doc_id long, text string, n_a string, piece int", data).repartition(3)
    want = sorted(((d[0], *p) for d, p in zip(data, plain([d[1] for d in data]))), key=str)
    got = aligned(docs, A, B, huge=huge, size=size)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(got) == want


def test_no_rows(spark, rows):
    assert aligned(rows("doc_id long, text string", []), A, B).collect() == []
    assert rows_of(aligned(rows("doc_id long, text string", [(1, None)]), A, B)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_diagonals_cut_equal_work():
    rng = np.random.default_rng(3)
    for _ in range(50):
        total = int(rng.integers(5, 400))
        a, b = (np.unique(np.append(rng.integers(1, total, rng.integers(1, total)), total)) for _ in range(2))
        size = int(rng.integers(1, 9))
        i, j = diagonals(a, b, size)
        assert (np.diff(i + j)[:-1] == size).all() and (i[-1], j[-1]) == (len(a), len(b))
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        assert [sum(1 for _, s in merged[:d] if s == 0) for d in i + j] == i.tolist()
        ids = np.arange(500)
        parts = [(x, y, *p.merged()) for x, y, p in pieces(ids[: len(a)], a, ids[: len(b)], b, size)]
        whole = Piece(ids[: len(a)], a, ids[: len(b)], b, 0).merged()
        assert sorted(np.concatenate([p[2] for p in parts])) == sorted(whole[0])
        assert np.concatenate([p[0] + p[4] for p in parts]).tolist() == whole[2].tolist()


def test_query_on_the_smallest_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect() if len(r.text or "") < 3000]
    got = aligned(spark.createDataFrame(docs, "doc_id long, text string"), A, B)
    assert rows_of(got) == sorted(((d, *p) for (d, _), p in zip(docs, plain([t for _, t in docs]))), key=str)
    assert op13_token_alignment(spark, folder).count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_ids_by_rank_are_the_file_s_own():
    a_file, b_model = open(A, encoding="utf-8").read(), open(B, "rb").read()
    assert by_rank(a_file)
    rng = np.random.default_rng(8)
    texts = [t or "" for t in TEXTS] + ["".join(map(chr, rng.integers(32, 0x2FF, rng.integers(1, 200)))) for _ in range(300)]
    texts += [bytes(rng.integers(97, 103, 3000, np.uint8)).decode(), "\x85\u2003\x1c\x1f a\u3000 b  \n\n c"]
    fast, own = (Tokens(a_file, b_model, ranked)._first(texts) for ranked in (True, False))
    assert [x.tolist() for x in fast] == [x.tolist() for x in own]


def test_a_file_whose_merges_do_not_make_its_tokens_is_not_ranked():
    file = json.load(open(A, encoding="utf-8"))
    file["model"]["merges"] = file["model"]["merges"][5:]
    assert not by_rank(json.dumps(file))
