import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from coverlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()
with open(PATH, encoding="utf-8") as file:
    VOC = bpe.Vocabulary(file.read())


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def own(text):
    return np.frombuffer(VOC.encode(text), "<u4").tolist()


TEXTS = [
    "", " ", "  \n\n a", "it's we'll 'll 'rEad don't", "a1b22 !!??x y z \x1c\x1d\x85​", "naïve Übergrößen ciónmente",
    "<|endoftext|>", "x<|endoftext|><|endoftext|> y <|endof", "日本語テキスト 🤖🤖", "a" * 3000, "ab" * 1000 + "c" * 777, "the" * 900,
    " " * 900 + "x", "\n" * 700, "'" * 600 + "s", "=" * 1001 + " end", "1234567890" * 120, "é" * 400, "\x00\x07", "antidisestablishmentarianism" * 60,
]


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids_as_the_library(text):
    assert own(text) == library(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="ab the\n'sd1.é ", max_size=200))
def test_same_ids_on_any_text(text):
    assert own(text) == library(text)
    assert VOC.decode(VOC.encode(text)) == LIBRARY.decode(library(text), skip_special_tokens=False)


def test_side_by_side_merging():
    raws = [w.encode() for w in ("a", "the", "ationtion", "éèê", "  ", "x" * 32, "ingtheandtion", "ab" * 16)]
    assert [np.frombuffer(b, "<u4").tolist() for b in VOC.merge_many(raws, 32)] == [VOC.merge(r) for r in raws]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdeth", min_size=1, max_size=120), st.text(alphabet="abcdeth", min_size=1, max_size=120))
def test_join_of_any_two_halves(a, b):
    assert VOC.join(VOC.merge(a.encode()), VOC.merge(b.encode())) == VOC.merge((a + b).encode()) == library(a + b)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aab the\n'sd11.!é", max_size=300), st.integers(9, 40))
def test_parts_join_to_the_whole(text, size):
    text = text * 3
    parts = list(VOC.parts(text, size))
    assert "".join(p for p, _ in parts) == text
    nodes = [bpe.Node(VOC.encode(p), inside, *VOC.edges(p)) for p, inside in parts]
    while len(nodes) > 1:
        nodes = [nodes[k].followed(nodes[k + 1], VOC) if k + 1 < len(nodes) else nodes[k] for k in range(0, len(nodes), 2)]
    assert np.frombuffer(nodes[0].ids, "<u4").tolist() == library(text)


@pytest.mark.parametrize("huge", [50, 1 << 22])
def test_rows(rows, huge):
    data = [(k, t) for k, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "no id"), (99, None), (98, "word " * 500), (98, "word " * 500)]
    df = rows("doc_id long, text string, ids string, part long", [(*d, "z", 1) for d in data])
    got = bpe.decode(bpe.encode(df, PATH, huge=huge), PATH, "doc_id").collect()
    want = [(i, np.array(library(t or ""), "<u4").tobytes(), LIBRARY.decode(library(t or ""), skip_special_tokens=False)) for i, t in data]
    key = lambda x: (str(x[0]), hashlib.md5(bytes(x[1])).hexdigest())
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in got), key=key) == sorted(want, key=key)


def test_empty_table(rows):
    assert bpe.decode(bpe.encode(rows("doc_id long, text string", []), PATH), PATH, "doc_id").collect() == []
