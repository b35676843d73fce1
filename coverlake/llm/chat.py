r"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is its turns end to end. A user's turn is ``[INST]text[/INST]``, an assistant's ``<s>text</s>``, any
other role's ``[ROLE name]text[/ROLE]``. The parser reads, from left to right, an opening mark, the shortest text up to
the closing mark of that kind, and so on; it accepts a string only if turns cover it without a gap.

Every turn is rendered as it is, parsed, and compared with its source. Where they differ, its text is escaped: it then
begins with ``\``, and ``\``, ``[`` and ``<`` inside have become ``\b``, ``\o`` and ``\l``, so that no mark can occur. Then
the whole conversation is parsed and compared; one that still differs has all its turns escaped. One that differs even
then is an error. Role names are always escaped, ``]`` as ``\c``.

The loss mask is the list of spans of the assistants' texts in the formatted string.

Defined cases: a null role or text is empty; turns come in the order of turn, role and text, a null turn first; rows
without a conversation id are one conversation without id; repeated rows are turns of their own; an empty table gives an
empty result; further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Opening and closing marks.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE ", "]", "[/ROLE]")
GRAMMAR = r"(?s)\[INST\].*?\[/INST\]|<s>.*?</s>|\[ROLE [^\]]*\].*?\[/ROLE\]"
ESCAPES = (("\\", "\\b"), ("[", "\\o"), ("<", "\\l"))
NAME_ESCAPES = (*ESCAPES, ("]", "\\c"))


def escape(text: Column, escapes=ESCAPES) -> Column:
    for plain, written in escapes:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, escapes=ESCAPES) -> Column:
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def body(text: Column, escaped: Column) -> Column:
    return F.when(escaped, F.concat(F.lit("\\"), escape(text))).otherwise(text)


def opening(role: Column) -> Column:
    other = F.concat(F.lit(OTHER[0]), escape(role, NAME_ESCAPES), F.lit(OTHER[1]))
    return F.when(role == "user", MARKS["user"][0]).when(role == "assistant", MARKS["assistant"][0]).otherwise(other)


def closing(role: Column) -> Column:
    return F.when(role == "user", MARKS["user"][1]).when(role == "assistant", MARKS["assistant"][1]).otherwise(OTHER[2])


def render(role: Column, text: Column, escaped: Column) -> Column:
    return F.concat(opening(role), body(text, escaped), closing(role))


def _between(part: Column, head: Column, tail: int) -> Column:
    """What stands after ``head`` characters and before the last ``tail``."""
    return part.substr(head + 1, F.length(part) - head - tail)


def _turn(part: Column) -> Column:
    """Role and text of one parsed turn."""

    def text(head: Column, tail: int) -> Column:
        inner = _between(part, head, tail)
        return F.when(F.startswith(inner, F.lit("\\")), unescape(inner.substr(F.lit(2), F.length(inner)))).otherwise(inner)

    kinds = []
    for role, (first, last) in MARKS.items():
        kinds.append((F.startswith(part, F.lit(first)), F.lit(role), text(F.lit(len(first)), len(last))))
    end = F.instr(part, OTHER[1])
    name = unescape(part.substr(F.lit(len(OTHER[0]) + 1), end - len(OTHER[0]) - 1), NAME_ESCAPES)
    kinds.append((F.lit(True), name, text(end, len(OTHER[2]))))
    (c0, r0, t0), (c1, r1, t1), (_, r2, t2) = kinds
    return F.struct(F.when(c0, r0).when(c1, r1).otherwise(r2).alias("role"), F.when(c0, t0).when(c1, t1).otherwise(t2).alias("text"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted string, as an array of (role, text); null if turns do not cover it."""
    parts = F.regexp_extract_all(formatted, F.lit(GRAMMAR), F.lit(0))
    covered = F.aggregate(parts, F.lit(0), lambda n, p: n + F.length(p)) == F.length(formatted)
    return F.when(covered, F.transform(parts, _turn))


def format_chat(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_spans`` (array of start, from 0, and length) and ``turns``, read back from ``formatted``."""
    t = turns.select(
        turns[id_col].cast("long").alias("conv_id"),
        turns[turn_col].cast("long").alias("turn"),
        F.coalesce(turns[role_col], F.lit("")).alias("role"),
        F.coalesce(turns[text_col], F.lit("")).alias("text"),
    )
    role, text = F.col("role"), F.col("text")
    back = parse(render(role, text, F.lit(False)))
    same = back.eqNullSafe(F.array(F.struct(role.alias("role"), text.alias("text"))))
    conversations = (
        t.withColumn("escaped", ~same).groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "escaped"))).alias("source"))
    )

    def whole(everything: bool) -> Column:
        each = lambda x: render(x.role, x.text, F.lit(True) if everything else x.escaped)
        return F.array_join(F.transform("source", each), "")

    want = F.transform("source", lambda x: F.struct(x.role.alias("role"), x.text.alias("text")))
    checked = (
        conversations.withColumn("formatted", whole(False)).withColumn("again", ~parse(F.col("formatted")).eqNullSafe(want))
        .withColumn("formatted", F.when(F.col("again"), whole(True)).otherwise(F.col("formatted")))
        .withColumn("turns", parse(F.col("formatted")))
    )
    sure = F.when(F.col("turns").eqNullSafe(want), F.col("turns")).otherwise(F.raise_error(F.lit("a conversation does not survive its round trip")))

    def measured(state: Column, x: Column) -> Column:
        """Goes on from the end of the turns so far; adds the span of an assistant's text."""
        inner = F.length(body(x.text, x.escaped | F.col("again")))
        head = F.length(opening(x.role))
        span = F.struct((state.at + head).alias("start"), inner.alias("length"))
        return F.struct(
            (state.at + head + inner + F.length(closing(x.role))).alias("at"),
            F.when(x.role == "assistant", F.concat(state.spans, F.array(span))).otherwise(state.spans).alias("spans"),
        )

    empty = F.from_json(F.lit("[]"), "array<struct<start:int,length:int>>")
    spans = F.aggregate("source", F.struct(F.lit(0).alias("at"), empty.alias("spans")), measured, lambda s: s.spans)
    return checked.select("conv_id", "formatted", spans.alias("loss_spans"), sure.alias("turns"))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, end to end."""

    def read(span: Column) -> Column:
        inner = formatted.substr(span.start + 1, span.length)
        return F.when(F.startswith(inner, F.lit("\\")), unescape(inner.substr(F.lit(2), F.length(inner)))).otherwise(inner)

    return F.array_join(F.transform(spans, read), "")
