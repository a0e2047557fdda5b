"""Line-first quality rules, in DataFrame functions only.

Each line with a word is judged by itself; failing lines are removed, and a
document that loses more than ``max_lost`` of its word characters, or fails
the base rules on length and repetition, is rejected.

Everything happens inside the row, so there is no shuffle: the repeated
three-word windows of a text come from sorting its window hashes, not from
exploding words over the cluster.
"""
from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import WORD, hold, table, whole_text, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Largest share of a document's word characters that its removed lines may hold.
MAX_LOST = 0.3
#: Marks per word from which a line is not prose.
MAX_MARKS = 0.25

#: Phrases of page furniture.  A short line that holds one is removed.
BOILERPLATE = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy", "use of cookies",
    "uses cookies", "accept cookies", "enable javascript", "javascript is disabled", "lorem ipsum", "sign up for",
    "subscribe to our", "click here", "read more", "share this", "skip to content", "back to top", "powered by",
)
BOILERPLATE_WORDS = 20
_SYMBOLS = r"[^#*$%&|<>]+"
_NOT_MARKS = r"[^!?#*$%&|<>{}\[\]~^=]+"
#: Replaced one by one: Java's regular expressions are slow on classes with characters beyond Latin-1.
_SEPARATORS = ("|", ">", "»", "•")
_SENTENCE_END = r"[.!?…。:;][\"'”’»)\]]*([\x20\x09-\x0D]|$)"
#: The operator's sentence ends: those of the SQL twin, and those of other scripts (Indic, Arabic, Urdu, full-width, Armenian, Ethiopic, Khmer, Burmese, Tibetan).
_LINE_END = r"[.!?…。:;।॥؟؛۔！？．｡：；։።፧។။།][\"'”’»)\]」』）】》]*([\x20\x09-\x0D]|$)"


def line_fails(line: Column) -> Column:
    """Whether a line breaks the punctuation, navigation or boilerplate rule; its words are those of ``WORD``."""
    n_words = F.regexp_count(line, F.lit(WORD))
    held = F.transform(F.array(F.struct(line.alias("x"), n_words.alias("n"))), _rules)
    return F.get(held, 0)


def _rules(line: Column) -> Column:
    x, n = line["x"], line["n"]
    marks = F.length(F.regexp_replace(x, _NOT_MARKS, "")) > MAX_MARKS * n
    bare = x
    for mark in _SEPARATORS:
        bare = F.replace(bare, F.lit(mark), F.lit(""))
    navigation = (F.length(x) - F.length(bare)) * 5 >= n
    low = F.lower(x)
    boilerplate = (n <= BOILERPLATE_WORDS) & reduce(or_, [F.contains(low, F.lit(p)) for p in BOILERPLATE])
    return (n > 2) & (marks | navigation | ~x.rlike(_LINE_END)) | boilerplate


def repeated_words(grams: Column) -> Column:
    """Words covered by windows that occur at least twice; ``grams`` is the sorted array of (hash, index)."""
    twin = lambda x, j: ((j > 0) & (F.get(grams, j - 1)["g"] == x["g"])) | F.coalesce(F.get(grams, j + 1)["g"] == x["g"], F.lit(False))
    return F.sort_array(F.transform(F.filter(grams, twin), lambda x: x["i"]))


def _kept_chars() -> Column:
    left = F.length(F.regexp_replace(F.array_join("__good_lines", "\n"), r"[\x20\x09-\x0D]+", ""))
    return F.when(F.size("__good_lines") == F.size("__lines"), F.col("__word_chars")).otherwise(left)


def rule_columns(docs: DataFrame, text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """``docs`` with ``__``-prefixed rule columns; rows and other columns stay as they are."""
    text = F.col("__text")
    step = docs.withColumn("__text", whole_text(text_col)).withColumn("__words", words_of(text))
    step = step.withColumns({
        "__n_words": F.size("__words").cast("long"),
        "__word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "__n_symbols": F.length(F.regexp_replace(text, _SYMBOLS, "")).cast("long"),
        "__hashes": F.transform("__words", lambda w: F.xxhash64(w)),
        "__lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
    }).drop("__words")
    h = F.col("__hashes")
    windows = F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))
    step = step.withColumns({
        "__windows": F.when(F.size(h) >= 3, windows),
        "__n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__good_lines": F.filter("__lines", lambda x: ~line_fails(x)),
    }).drop("__hashes")
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    sorted_windows = F.sort_array(F.transform("__windows", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    step = step.withColumns({"__grams": F.when(repeats, sorted_windows), "__good_chars": _kept_chars()}).drop("__windows", "__lines")
    step = step.withColumn("__at", repeated_words(F.col("__grams"))).drop("__grams")
    at = F.col("__at")
    covered = F.aggregate(F.sequence(F.lit(1), F.size(at)), F.lit(0), lambda acc, k: acc + F.least(F.lit(3), F.coalesce(F.get(at, k) - F.get(at, k - 1), F.lit(3))))
    step = step.withColumn("__n_repeat_words", F.when(at.isNull(), 0).otherwise(covered).cast("long")).drop("__at")
    step = step.withColumn("__base_failed", (F.col("__n_words") < MIN_WORDS) | (100 * F.col("__n_repeat_words") > MAX_REPEAT_PERCENT * F.col("__n_words")))
    lost = F.col("__word_chars") - F.col("__good_chars")
    return step.withColumn("__kept", ~F.col("__base_failed") & (lost <= max_lost * F.col("__word_chars")))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """The verdict per row: counts, ``base_failed`` and ``kept``.

    Null text counts as empty: no words, so ``base_failed``.  Null ids and
    repeated rows give a row each; columns other than id and text are ignored.
    """
    step = rule_columns(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", max_lost)
    return step.select(
        "doc_id", *[F.col(f"__{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")],
        (F.col("__word_chars") - F.col("__good_chars")).cast("long").alias("lost_chars"),
    )


def clean(docs: DataFrame, text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """The kept documents, their failing lines removed; a character count column ``n_chars`` follows the text.

    A text without a failing line stays as it is, blank lines included.
    """
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    wanted = [*names.values(), "__kept", "__good_lines", "__good_chars", "__word_chars"]
    step = hold(rule_columns(docs.withColumnsRenamed(names), names[text_col], max_lost).select(*wanted)).filter("__kept")
    step = step.withColumnsRenamed({v: k for k, v in names.items()})
    lines = F.array_join("__good_lines", "\n")
    text = F.when(F.col("__good_chars") == F.col("__word_chars"), F.col(text_col)).otherwise(lines)
    out = step.withColumn(text_col, text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same rows in DuckDB: windows as text, covered words as distinct places."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    bare = "l"
    for mark in _SEPARATORS:
        bare = f"replace({bare}, '{mark}', '')"
    phrases = " OR ".join(f"contains(lower(l), {quote(p)})" for p in BOILERPLATE)
    space = r"[\x20\x09-\x0D]+"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT doc_id, text, regexp_extract_all(text, {quote(WORD)}) AS words FROM d),
    g AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
    t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS c FROM g),
    r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM t WHERE c > 1) GROUP BY doc_id),
    l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d),
    f AS (SELECT doc_id, l, length(l) - length(replace(l, ' ', '')) + 1 AS n FROM l WHERE regexp_matches(l, {quote(WORD)})),
    j AS (SELECT doc_id, l, length(regexp_replace(l, '{space}', '', 'g')) AS chars,
                 (n > 2 AND (length(regexp_replace(l, {quote(_NOT_MARKS)}, '', 'g')) > {MAX_MARKS} * n
                             OR (length(l) - length({bare})) * 5 >= n
                             OR NOT regexp_matches(l, {quote(_SENTENCE_END)})))
                 OR (n <= {BOILERPLATE_WORDS} AND ({phrases})) AS fails FROM f),
    s AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines, coalesce(sum(chars) FILTER (fails), 0) AS lost_chars FROM j GROUP BY doc_id),
    a AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{space}', '', 'g')) AS BIGINT) AS word_chars,
                 CAST(length(regexp_replace(text, {quote(_SYMBOLS)}, '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
                 CAST(coalesce(lost_chars, 0) AS BIGINT) AS lost_chars
          FROM w LEFT JOIN r ON r.doc_id = w.doc_id LEFT JOIN s ON s.doc_id = w.doc_id)
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
           NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND lost_chars <= {MAX_LOST} * word_chars AS kept
    FROM a"""


ORACLE = _oracle()
