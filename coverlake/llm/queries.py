"""The registered queries of this package: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlake.llm import bpe
from coverlake.llm.alignment import aligned
from coverlake.llm.chat import format_chat, masked_text
from coverlake.llm.common import table
from coverlake.llm.decontaminate import overlaps
from coverlake.llm.exact import exact_duplicates
from coverlake.llm.ngram_lm import lm_scores
from coverlake.llm.phrases import collocations
from coverlake.llm.quality import quality
from coverlake.llm.secrets import secret_scan
from coverlake.llm.simhash import simhash_groups
from coverlake.llm.stages import PIECES, VOCABULARY
from coverlake.llm.substrings import shared_passages
from coverlake.llm.toxicity import toxicity
from coverlake.llm.vectors import near_vectors


def op1_bpe(spark, folder):
    coded = bpe.decode(bpe.encode(table(spark, folder, "documents"), VOCABULARY), VOCABULARY, "doc_id")
    return coded.select("doc_id", *bpe.digests())


def op2_substring_dedup(spark, folder):
    return shared_passages(table(spark, folder, "documents"))


def op3_simhash_near_dedup(spark, folder):
    return simhash_groups(table(spark, folder, "documents"), shingle=3, distance=2)


def op4_quality(spark, folder):
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_chat_format(spark, folder):
    probe = spark.sql(
        """SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
        FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"""
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    loss = masked_text(F.col("formatted"), F.col("loss_spans"))
    written = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return format_chat(rows).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(written.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_lm_scores(spark, folder):
    return lm_scores(table(spark, folder, "documents"))


def op7_decontamination(spark, folder):
    return overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ends=True)


def op8_exact_dedup(spark, folder):
    found = exact_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_secret_scan(spark, folder):
    return secret_scan(table(spark, folder, "documents"), path_col="source")


def op10_toxicity(spark, folder):
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_phrases(spark, folder):
    return collocations(table(spark, folder, "documents"))


def op12_near_vectors(spark, folder):
    return near_vectors(table(spark, folder, "embeddings"))


def op13_token_alignment(spark, folder):
    return aligned(table(spark, folder, "documents"), VOCABULARY, PIECES)


QUERIES = {f.__name__: f for f in (op1_bpe, op2_substring_dedup, op3_simhash_near_dedup, op4_quality, op5_chat_format, op6_lm_scores, op7_decontamination, op8_exact_dedup, op9_secret_scan, op10_toxicity, op11_phrases, op12_near_vectors, op13_token_alignment)}

SQL = {
    "op5_chat_format": r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
),
m AS (
    SELECT *,
           CASE role WHEN 'user' THEN '[INST]' WHEN 'assistant' THEN '<s>'
               ELSE '[ROLE ' || replace(replace(replace(replace(role, '\', '\b'), '[', '\o'), '<', '\l'), ']', '\c') || ']' END AS head,
           CASE role WHEN 'user' THEN '[/INST]' WHEN 'assistant' THEN '</s>' ELSE '[/ROLE]' END AS tail
    FROM c
),
b AS (
    SELECT *,
           CASE WHEN contains(text, tail) OR starts_with(text, '\')
               THEN '\' || replace(replace(replace(text, '\', '\b'), '[', '\o'), '<', '\l') ELSE text END AS body
    FROM m
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS bigint) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(length(head) + length(body) + length(tail)) AS bigint) AS formatted_chars
FROM b GROUP BY conv_id
""",
    "op11_phrases": r"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
one AS (SELECT lang, unnest(ws) AS a FROM w),
two AS (SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: {'a': ws[i], 'b': ws[i + 1]}), recursive := true) FROM w),
three AS (SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: {'a': ws[i], 'b': ws[i + 1], 'c': ws[i + 2]}), recursive := true) FROM w),
f1 AS (SELECT lang, a, CAST(count(*) AS hugeint) AS f FROM one GROUP BY ALL),
f2 AS (SELECT lang, a, b, CAST(count(*) AS hugeint) AS f FROM two GROUP BY ALL),
f3 AS (SELECT lang, a, b, c, CAST(count(*) AS hugeint) AS f FROM three GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, count(*) AS n FROM one GROUP BY lang),
longer AS (
    SELECT lang, a, b, max(f) AS f FROM (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b AS a, c AS b, f FROM f3) GROUP BY ALL
),
cuts AS (
    SELECT x.lang, x.a || ' ' || x.b AS phrase, 1 AS k, x.f AS a, l.f AS l, r.f AS r
    FROM f2 x JOIN f1 l ON l.lang = x.lang AND l.a = x.a JOIN f1 r ON r.lang = x.lang AND r.a = x.b
    LEFT JOIN longer g ON g.lang = x.lang AND g.a = x.a AND g.b = x.b
    WHERE x.f >= 10 AND 100 * coalesce(g.f, 0) < 50 * x.f
    UNION ALL
    SELECT x.lang, x.a || ' ' || x.b || ' ' || x.c, 1, x.f, l.f, r.f
    FROM f3 x JOIN f1 l ON l.lang = x.lang AND l.a = x.a JOIN f2 r ON r.lang = x.lang AND r.a = x.b AND r.b = x.c
    UNION ALL
    SELECT x.lang, x.a || ' ' || x.b || ' ' || x.c, 2, x.f, l.f, r.f
    FROM f3 x JOIN f2 l ON l.lang = x.lang AND l.a = x.a AND l.b = x.b JOIN f1 r ON r.lang = x.lang AND r.a = x.c
),
scored AS (SELECT *, 1000000 * a * a // (l * r) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT ranked.lang, rank, phrase, CAST(a AS bigint) AS a, CAST(l AS bigint) AS l, CAST(r AS bigint) AS r, n.n, CAST(score AS bigint) AS score
FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
""",
    "op8_exact_dedup": r"""
WITH n AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
),
g AS (
    SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t
)
SELECT n.doc_id, g.keep_id, g.group_size,
       n.doc_id IS NOT DISTINCT FROM g.keep_id
           AND row_number() OVER (PARTITION BY n.t, n.doc_id ORDER BY 1) = 1 AS kept,
       sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
""",
}
