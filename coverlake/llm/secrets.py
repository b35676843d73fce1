"""Secret scan: candidates are found by form, and a random forest removes the false ones. DataFrame functions only.

A word is taken out of quotes and of ``name=`` in front of it; a word of another form, as in JSON without white space, CSV
rows or URLs, gives its ``name=value`` and ``name:value`` pairs, the password of ``user:password@``, keys of an issued form, and
the fields between separators. Each is a candidate if it has ``LEAST`` characters or more and a digit, or, however
short, a secret's name before it. It is described by its length, its kinds of characters and how they follow each other, the share of it that
words of the corpus cover, marks in the document's path, and the words beside it. The forest learns from labelled
findings: ``label`` is 1 for a true secret, 0 for a false alarm, null for unknown. ``review`` labels those findings whose form
leaves no doubt; a team's own labels can be given instead. The dictionary is counted over all documents; the forest is
grown on a bounded sample (``rows``) of labelled findings outside the held-out fold.

Defined cases: a null text is an empty one; a null path has no mark; a document without candidates has no row; equal rows give equal rows; without
both labels every candidate has score 1, so nothing is removed; an empty table gives an empty result; further columns
are not looked at.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlake.llm.common import held_out, stored

LEAST = 12
#: A dictionary word: letters only, this long, this often in the corpus.
WORD_LENGTH, WORD_COUNT = (3, 10), 10
#: Labelled findings learned from at most.
ROWS = 20_000
TREES, DEPTH = 20, 6
THRESHOLD = 0.5
FOLDS, HELD_OUT = 3, 1

#: Words that stand beside secrets, beside other long values, and in paths of test data.
SECRET_WORDS = "pass|pwd|token|secret|key|auth|cred|bearer|private"
OTHER_WORDS = "sha|md5|hash|commit|digest|checksum|uuid|guid|version|phone|tel|card|mail|http|order|isbn"
TEST_PATHS = "test|example|sample|fixture|mock|demo|doc|lock|vendor"

#: A secret's name and = or : at the end of the words before a value.
ASSIGNED = rf"(?i)({SECRET_WORDS})[A-Za-z0-9_.-]*[\"']? ?(=>|[=:])$"
#: Parts of a word: a name and its value, the password in a URL, a field between separators, keys of issued forms.
PAIR = r"""([A-Za-z_][A-Za-z0-9_.-]*)["']?(?:=>|[=:])(?!//)["'(\[<]*([^"'(),;|&<>\[\]{}=:]+=*)"""
LOGIN = r"://[^:/@]*:([^/@]+)@"
FIELD = r"""[^,;|&?"'<>(){}\[\]]+"""
ISSUED = r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})(?![A-Za-z0-9])"

FEATURES = [
    "length", "digits", "upper", "lower", "signs", "turns", "distinct", "hex", "sounds", "covered", "ats", "dots", "named",
    "secret_word", "other_word", "quoted", "test_path", "path_depth",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """``doc_id``, ``path``, ``pos`` (number of the word), ``value``, ``name`` before it, ``quoted``, and the words ``beside`` it."""
    path = F.coalesce(docs[path_col].cast("string"), F.lit("")) if path_col else F.lit("")
    words = F.split(F.coalesce(docs[text_col], F.lit("")), r"[\x20\x09-\x0D]+")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), path.alias("path"), words.alias("words"))
    numbered = F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word")))

    def at(pos: Column) -> Column:
        return F.coalesce(F.get("words", pos), F.lit(""))

    def assigned(x: Column) -> Column:
        return F.concat_ws(" ", at(x.pos - 2), at(x.pos - 1)).rlike(ASSIGNED)

    named = rf"(?i)({SECRET_WORDS})[A-Za-z0-9_.-]*[\"']?(=>|[=:])."
    told = F.filter(numbered, lambda x: ((F.length(x.word) >= LEAST) & x.word.rlike("[0-9]")) | x.word.rlike(named) | x.word.rlike(LOGIN) | assigned(x))
    found = rows.select("doc_id", "path", "words", F.explode(told).alias("w"))
    w = F.col("w.word")
    form = r"""^[^A-Za-z0-9]*(?:([A-Za-z_][A-Za-z0-9_.-]*)[=:])?["'(\[<]*([A-Za-z0-9+/_.@=-]*[A-Za-z0-9])[^A-Za-z0-9]*$"""
    value = F.regexp_extract(w, form, 2)

    def part(name: Column, text: Column) -> Column:
        return F.struct(name.alias("name"), F.regexp_replace(text, r"^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "").alias("value"))

    def every(text: Column, pattern: str, group: int) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    none = F.lit("")
    rest = F.regexp_replace(w, LOGIN, "://")
    pairs = F.zip_with(every(rest, PAIR, 1), every(rest, PAIR, 2), part)
    logins = F.transform(every(w, LOGIN, 1), lambda v: F.struct(F.lit("password").alias("name"), v.alias("value")))
    fields = F.transform(every(F.regexp_replace(rest, PAIR, ","), FIELD, 0), lambda v: part(none, v))
    one = F.array(F.struct(F.regexp_extract(w, form, 1).alias("name"), value.alias("value")))
    parts = F.when(value != "", one).otherwise(F.concat(logins, pairs, fields))
    found = found.withColumn("parts", parts)
    issued = F.filter(every(w, ISSUED, 0), lambda v: ~F.exists("parts", lambda p: p.value == v))
    found = found.withColumn("parts", F.array_distinct(F.concat("parts", F.transform(issued, lambda v: F.struct(none.alias("name"), v.alias("value"))))))
    p = F.col("w.pos")
    return (
        found.select("doc_id", "path", "words", "w", assigned(F.col("w")).alias("assigned"), F.explode("parts").alias("part"))
        .filter("part.value <> ''")
        .filter(
            ((F.length("part.value") >= LEAST) & F.col("part.value").rlike("[0-9]"))
            | F.lower("part.name").rlike(SECRET_WORDS)
            | (F.col("assigned") & (F.col("part.name") == ""))
        )
        .select(
            "doc_id",
            "path",
            p.cast("long").alias("pos"),
            F.col("part.value").alias("value"),
            F.col("part.name").alias("name"),
            w.rlike("""["']""").cast("double").alias("quoted"),
            F.lower(F.concat_ws(" ", at(p - 3), at(p - 2), at(p - 1), at(p + 1))).alias("beside"),
        )
    )


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Lower-case words (``part``) that the whole corpus has often enough, counted per task before the shuffle."""
    low, high = WORD_LENGTH
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(docs[text_col]), F.lit("[a-z]+"), F.lit(0))).alias("part"))
    words = words.filter(F.octet_length("part").between(low, high))
    return words.groupBy("part").agg(F.count("*").alias("n")).filter(F.col("n") >= WORD_COUNT).select("part")


def _left(text: Column, pattern: str) -> Column:
    """How many characters of a text a pattern takes away."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with the columns of FEATURES."""
    runs = found.select("value", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,10}"), F.lit(0)))).alias("part"))
    known = stored(runs.select("part").distinct().join(words, "part"))
    covered = (
        runs.distinct().join(known, "part")
        .select("value", "part", F.expr("(length(value) - length(replace(lower(value), part, '')))").alias("n"))
        .groupBy("value").agg(F.sum("n").alias("letters"))
    )
    v, size = F.col("value"), F.length("value").cast("double")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[A-Z]", "U"), "[a-z]", "l"), "[0-9]", "d"), "[^Uld]", "s")
    merged = F.regexp_replace(kinds, r"(.)\1+", "$1")
    sounds = F.size(F.regexp_extract_all(F.lower(v), F.lit("[bcdfghjklmnpqrstvwxz][aeiou]"), F.lit(0)))
    context = F.concat_ws(" ", F.lower("name"), "beside")
    return found.join(covered, "value", "left").select(
        "doc_id", "pos", "value", "path", "name", "beside",
        size.alias("length"),
        (_left(v, "[0-9]") / size).alias("digits"),
        (_left(v, "[A-Z]") / size).alias("upper"),
        (_left(v, "[a-z]") / size).alias("lower"),
        (_left(v, "[^A-Za-z0-9]") / size).alias("signs"),
        ((F.length(merged) - 1) / size).alias("turns"),
        (F.size(F.array_distinct(F.split(v, ""))) / F.least(size, F.lit(36.0))).alias("distinct"),
        v.rlike("^[0-9a-fA-F]+$").cast("double").alias("hex"),
        (sounds / size).alias("sounds"),
        F.least(F.lit(1.0), F.coalesce("letters", F.lit(0)) / size).alias("covered"),
        _left(v, "@").alias("ats"),
        _left(v, r"\.").alias("dots"),
        (F.col("name") != "").cast("double").alias("named"),
        context.rlike(SECRET_WORDS).cast("double").alias("secret_word"),
        context.rlike(OTHER_WORDS).cast("double").alias("other_word"),
        "quoted",
        F.lower("path").rlike(TEST_PATHS).cast("double").alias("test_path"),
        _left(F.col("path"), "/").alias("path_depth"),
    )


def review(found: DataFrame) -> DataFrame:
    """Adds ``label`` where the form leaves no doubt: issued key ids and keyed hex or mixed values against addresses, numbers and plain names."""
    v = F.col("value")
    mixed = v.rlike("[0-9]") & v.rlike("[A-Za-z]") & v.rlike("^[A-Za-z0-9+/_=-]{16,}$")
    keyed = F.lower("name").rlike(SECRET_WORDS) | F.col("beside").rlike(f"({SECRET_WORDS})[a-z_]*( ?[=:])")
    short = F.lower("name").rlike(SECRET_WORDS) & v.rlike("^(?=.*[0-9])(?=.*[A-Za-z])[^/@.]{6,15}$")
    true = v.rlike(f"^{ISSUED}$") | (mixed & keyed) | short
    plain = v.rlike("^[a-z]+([-_./][a-z]+)*[0-9]{0,2}$") & ~keyed
    # an address with a long mixed part may hold a token: it is left open
    address = v.rlike("^(https?|www|//)") & ~v.rlike("[/?&#=](?=[A-Za-z_+-]*[0-9])(?=[0-9_+-]*[A-Za-z])[A-Za-z0-9_+-]{16,}")
    false = v.rlike(r"^[^@]+@[^@]+\.[a-z]+$") | v.rlike(r"^[0-9.:/+-]+$") | plain | address
    return found.withColumn("label", F.when(false, 0).when(true, 1))


def fit(labelled: DataFrame, rows: int = ROWS):
    """A forest grown on up to ``rows`` / 2 findings of each label, in the order of a hash; None without both labels."""
    order = F.xxhash64("doc_id", "pos", "value")
    known = labelled.filter(F.col("label").isin(0, 1) & ~held_out("doc_id", FOLDS, HELD_OUT)).withColumn("order", order)
    taken = [known.filter(F.col("label") == k).orderBy("order", "doc_id", "pos").limit(rows // 2) for k in (0, 1)]
    sample = stored(taken[0].unionByName(taken[1]).select(*FEATURES, F.col("label").cast("double").alias("label")))
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample))


def judged(found: DataFrame, forest) -> DataFrame:
    """Adds ``score``, the forest's chance of a true secret."""
    if forest is None:
        return found.withColumn("score", F.lit(1.0))
    with_vector = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    return forest.transform(with_vector).withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def secret_scan(
    docs: DataFrame, labels: DataFrame | None = None, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None
) -> DataFrame:
    """Every candidate: ``doc_id``, ``pos``, ``value``, ``held_out``, ``score`` and ``predicted`` (1: a secret).

    ``labels`` (``doc_id``, ``pos``, ``label``, and ``value`` where a word has several) are labelled findings; without them
    ``review`` labels.
    """
    found = stored(described(stored(candidates(docs, id_col, text_col, path_col)), dictionary(docs, text_col)))
    if labels is None:
        labelled = review(found)
    else:
        key = ["doc_id", "pos", *[c for c in ("value",) if c in labels.columns]]
        own = labels.groupBy(*key).agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most")
        labelled = found.join(own.select(*key, "label"), key)
    return judged(found, fit(labelled, rows)).select(
        "doc_id", "pos", "value", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
