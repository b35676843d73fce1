import re

import pytest

from coverlake.llm import chat

HARD = [
    "", " ", "\\", "\\b", "\\o\\l", "a\\", "[INST]", "[/INST]", "x[/INST]", "</s>", "<s></s>", "</s>[INST] ok [/INST]", "[/INS", "[/INST",
    "[ROLE a]", "[/ROLE]", "]", "[", "<", "\n\n", "é[/INST]é</s>日本", "$1 \\1 $", "[/INST]" * 50, "plain text",
]
ROLES = ["user", "assistant", "system", "", None, "a]b", "[/ROLE]", "User", "\\c", "x[INST]"]


def reparse(text):
    """The grammar, by hand."""
    out, at = [], 0
    while at < len(text):
        if text.startswith("[INST]", at):
            role, low, close = "user", at + 6, "[/INST]"
        elif text.startswith("<s>", at):
            role, low, close = "assistant", at + 3, "</s>"
        else:
            assert text.startswith("[ROLE ", at)
            end = text.index("]", at)
            role, low, close = undo(text[at + 6 : end]), end + 1, "[/ROLE]"
        high = text.index(close, low)
        body = text[low:high]
        out.append((role, undo(body[1:]) if body.startswith("\\") else body, (low, high - low)))
        at = high + len(close)
    return out


def undo(text):
    return re.sub(r"\\([bolc])", lambda m: {"b": "\\", "o": "[", "l": "<", "c": "]"}[m[1]], text)


def test_round_trip(rows):
    data, n = [], 0
    for c, role in enumerate(ROLES):
        for text in HARD:
            data.append((c, n, role, text))
            n += 1
    data += [(100 + k, 0, "assistant", t) for k, t in enumerate(HARD)] + [(200 + k, 0, "user", t) for k, t in enumerate(HARD)]
    data += [(300, 1, "assistant", "b"), (300, None, "user", None), (300, 1, "assistant", "b"), (300, 1, "assistant", "a"), (None, 0, "user", "none")]
    df = rows("conv_id long, turn long, role string, text string, formatted string, source int", [(*d, "q", 1) for d in data])
    mask = chat.masked_text(chat.F.col("formatted"), chat.F.col("loss_spans"))
    got = {r.conv_id: r for r in chat.format_chat(df).withColumn("mask", mask).collect()}
    by_id = {}
    for c, turn, role, text in data:
        by_id.setdefault(c, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(by_id)
    for c, turns in by_id.items():
        want = [t[1:] for t in sorted(turns)]
        r = got[c]
        assert [(t.role, t.text) for t in r.turns] == want
        back = reparse(r.formatted)
        assert [b[:2] for b in back] == want
        assert [(s.start, s.length) for s in r.loss_spans] == [b[2] for b in back if b[0] == "assistant"]
        assert r.mask == "".join(t for role, t in want if role == "assistant")


@pytest.mark.parametrize("text", ["junk", "[INST]a", "<s>a</s>tail", "[INST]a[/INST] [INST]b[/INST]"])
def test_strings_outside_the_grammar_are_refused(rows, text):
    assert rows("s string", [(text,)]).select(chat.parse(chat.F.col("s")).alias("t")).first().t is None


def test_plain_text_is_not_escaped_and_plan_is_native(rows):
    df = chat.format_chat(rows("conv_id long, turn long, role string, text string", [(1, 0, "user", "a\\b [x] <y>"), (1, 1, "assistant", "[INST] hi")]))
    assert df.first().formatted == "[INST]a\\b [x] <y>[/INST]<s>[INST] hi</s>"
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_empty_table(rows):
    assert chat.format_chat(rows("conv_id long, turn long, role string, text string", [])).collect() == []
