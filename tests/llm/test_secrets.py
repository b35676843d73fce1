import random
import re
import string

from pyspark.sql import functions as F

from coverlake.llm import secrets


def corpus(rng, n=300):
    docs, truth = [], {}
    words = ["the", "river", "mill", "example", "mail", "com", "order", "field", "stone", "paper"]
    code = lambda k, a: "".join(rng.choice(a) for _ in range(k))
    for i in range(n):
        text = " ".join(rng.choices(words, k=40))
        kind = i % 6
        secret = [
            "AKIA" + code(16, string.ascii_uppercase + "0123456789"),
            f"password={code(18, '0123456789abcdef')}",
            f'token = "{code(40, "0123456789abcdef")}"',
            f"{rng.choice(words)}{rng.choice(words)}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
            code(16, "0123456789"),
            f"{rng.randrange(100, 255)}.{rng.randrange(100, 255)}.{rng.randrange(100, 255)}.{rng.randrange(100, 255)}",
        ][kind]
        docs.append((i, f"{text} {secret} {text}\n{text}", "src/app.py"))
        truth[i] = int(kind < 3)
    return docs, truth


def test_secrets_are_told_from_other_values(rows):
    docs, truth = corpus(random.Random(11))
    data = docs + [(900, None, None), (901, "", "x"), (902, "plain words only", None), docs[0], (None, docs[1][1], None)]
    df = rows("doc_id long, text string, path string, value string, label int", [(*d, "q", 0) for d in data])
    result = secrets.secret_scan(df, path_col="path")
    assert not re.search("Python|Pandas|Arrow", result._jdf.queryExecution().executedPlan().toString())
    got = result.collect()
    seen = {}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        seen.setdefault(r.doc_id, set()).add(r.predicted)
    assert {i: max(p) for i, p in seen.items() if i is not None} == truth and seen[None] == {1}
    assert len(got) == len(docs) + 2


def test_given_labels_are_learned(rows):
    """Numbers are secrets here."""
    docs, truth = corpus(random.Random(12))
    df = rows("doc_id long, text string, path string", docs)
    where = secrets.candidates(df).select("doc_id", "pos").collect()
    labels = rows("doc_id long, pos long, label int", [(r.doc_id, r.pos, int(r.doc_id % 6 == 4)) for r in where] + [(1, None, 1), (None, 3, 0)])
    got = secrets.secret_scan(df, labels).collect()
    assert all(r.predicted == int(r.doc_id % 6 == 4) for r in got) and len(got) == len(docs)


def test_candidates(rows):
    df = rows("doc_id long, text string", [(1, 'a b\tkey: "Ab3dEf6hIj9kLm2n", then x=short1 (https://h.example/p?q=12) päss1234567890é'), (2, "no_digit_here_at_all")])
    got = {r.value: (r.pos, r.name, r.quoted, r.beside) for r in secrets.candidates(df).collect()}
    assert got["Ab3dEf6hIj9kLm2n"] == (3, "", 1.0, "a b key: then")
    assert "no_digit_here_at_all" not in got and not any(v.startswith("short") for v in got)


def test_without_labels_or_rows_nothing_is_removed(rows):
    got = secrets.secret_scan(rows("doc_id long, text string", [(1, "value 1234567890abcdefgh")])).collect()
    assert [(r.score, r.predicted) for r in got] == [(1.0, 1)]
    assert secrets.secret_scan(rows("doc_id long, text string", [])).collect() == []


def test_dictionary_counts_the_whole_corpus(rows):
    df = rows("doc_id long, text string", [(k, "Word word rare" + str(k) + " é") for k in range(6)])
    assert {r.part for r in secrets.dictionary(df).select(F.col("part")).collect()} == {"word"}


def test_candidates_within_words_and_after_secret_names(rows):
    key = "AKIA" + "Z9" * 8
    texts = [
        ('{"user":"ann","password":"hunter2","api_key":"0a1b2c3d4e5f6a7b"}', {"hunter2", "0a1b2c3d4e5f6a7b"}),
        (f"7,ann,{key},2024", {key}),
        ("https://h.example/a?page=2&token=9f8e7d6c5b4a3f2e1d0c", {"9f8e7d6c5b4a3f2e1d0c"}),
        ("postgres://ann:s3cr3tpw@db.example/x", {"s3cr3tpw"}),
        ("a password=hunter2 b", {"hunter2"}),
        ("a password: letmein b", {"letmein"}),
        ('a secret = "correcthorsebattery" b', {"correcthorsebattery"}),
        (f"see:{key}/x", {key}),
        ("only words page=2 x:short", set()),
    ]
    got = {}
    found = secrets.candidates(rows("doc_id long, text string", [(k, x) for k, (x, _) in enumerate(texts)])).collect()
    for r in found:
        got.setdefault(r.doc_id, set()).add(r.value)
    for k, (text, want) in enumerate(texts):
        assert want <= got.get(k, set()) and (want or k not in got), (text, got.get(k))


def test_addresses_with_tokens_are_not_taught_as_false(rows):
    df = rows("doc_id long, text string", [(1, "https://h.example/s/9f8e7d6c5b4a3f2e1d0c"), (2, "https://h.example/page/12345"), (3, "password=hunter2")])
    words = rows("part string", [])
    got = {r.doc_id: r.label for r in secrets.review(secrets.described(secrets.candidates(df), words)).collect()}
    assert got == {1: None, 2: 0, 3: 1}


def test_dictionary_counts_words_beside_other_white_space_and_signs(rows):
    df = rows("doc_id long, text string", [(k, "river\nmill\tstone,(field) paper.\r\norder") for k in range(10)])
    assert {r.part for r in secrets.dictionary(df).collect()} == {"river", "mill", "stone", "field", "paper", "order"}
