"""Quality classifier from weak labels.

Heuristic labellers, each for one kind of junk, call a document bad or say nothing.  Expectation-
maximisation estimates how often each is right from the votes alone, without a
labelled document; the posterior of a document's votes is its soft label.  A
linear scorer over hashed word shapes, and over the shares of words, windows and
lines that the text has said before, learns the soft labels and judges every
document by its own words, whatever the labellers said.

Scale: the vote patterns are counted with a partial aggregate, at most
2^labellers rows, and the estimation runs on the counts, so it sees all
documents.  The scorer is fitted on a bounded sample (``SAMPLE`` documents,
chosen by a hash of the id) and is an array of ``BUCKETS`` numbers inside one
expression: scoring needs no shuffle.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import table, whole_text, words_of

#: Documents the linear scorer is fitted on, and the hash buckets of its features.
SAMPLE, BUCKETS = 3000, 1024
#: Passes of the estimation and of the fit, and the fit's step and penalty.
EM_ROUNDS, FIT_ROUNDS, STEP, PENALTY = 60, 1500, 10.0, 1e-5
#: Words added to a text's number of words, so that a few words say little.
PAD = 10
#: Words of a window, and the scorer's numbers beside the buckets: shares of the text that it has said before.
WINDOW, REPEATS = 3, ("words", "windows", "lines")
#: Probability of being good from which a document is kept.
KEEP = 0.5


def statistics(text: Column) -> dict[str, Column]:
    """What the labellers look at, each one pass over the text."""
    count = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    return {
        "chars": F.length(text), "symbols": count(r"[^#*$%&|<>{}\[\]~^=]+"),
        "shouts": count(r"[^!?]+"), "upper": count(r"[^A-Z]+"), "letters": count(r"[^A-Za-z]+"), "ends": count(r"[^.]+"), "digits": count(r"[^0-9]+"),
        "lines": F.split(text, "\n"), "words": words_of(text),
    }


def votes(s: Column) -> dict[str, Column]:
    """The labellers, each true where it calls a document bad; ``s`` is the struct of statistics.

    A labeller knows one kind of junk, so its silence says little and only its
    calls are modelled.
    """
    n = F.greatest(F.size(s["words"]), F.lit(1))
    rate = lambda c: s[c] / n
    long = n >= 30  # of fewer words, most of these say nothing
    # the number of different words grows more slowly than the text, so it is judged against the square root
    distinct = F.size(F.array_distinct(s["words"]))
    return {
        "symbols": rate("symbols") > 0.2,
        "shouts": rate("shouts") > 0.3,
        "capitals": long & (s["upper"] > 0.4 * s["letters"]),
        "variety": long & (distinct < 0.5 * F.least(n, 4 * F.sqrt(n.cast("double")))),
        "sentences": long & ((s["ends"] * 60 < n) | (s["ends"] * 3 > n * 2)),
        "digits": s["digits"] > 0.2 * s["chars"],
        "lines": (F.size(s["lines"]) > 4) & (F.size(F.array_distinct(s["lines"])) < 0.7 * F.size(s["lines"])),
        "word_length": long & ((s["chars"] > 14 * n) | (s["chars"] < 3 * n)),
    }


LABELLERS = ("symbols", "shouts", "capitals", "variety", "sentences", "digits", "lines", "word_length")


def shapes(text: Column) -> Column:
    """The words with runs of capitals, small letters and digits each written as one: few and telling."""
    for pattern, mark in (("[A-Z]+", "A"), ("[a-z]+", "a"), ("[0-9]+", "0"), (r"[^\x00-\x7F]+", "e")):
        text = F.regexp_replace(text, pattern, mark)
    return words_of(text)


#: Where estimation starts: the share of bad documents, and of bad and good documents that a labeller calls bad.
START_BAD, START_CALLS = 0.2, (0.3, 0.01)
#: A labeller may call this share of the good documents bad.  Without the bound, estimation would take the one
#: commonest kind of junk for the whole bad class, and each other kind for good documents that some labeller mistakes.
FALSE_ALARMS = 0.002


class Accuracies:
    """Naive-Bayes model of the calls given the hidden label, by expectation-maximisation over counted patterns."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS, false_alarms: float = FALSE_ALARMS):
        m = patterns.shape[1]
        self.bad = START_BAD
        #: By labeller, the share of bad documents and of good documents that it calls bad.
        self.calls = np.tile(np.array(START_CALLS)[:, None], (1, m))
        for _ in range(rounds if counts.sum() else 0):
            good = self.good(patterns)
            q = np.stack([(1 - good) * counts, good * counts])
            self.bad = float((q[0].sum() + 1) / (counts.sum() + 2))
            self.calls = (q @ patterns + 0.5) / (q.sum(axis=1, keepdims=True) + 1)
            self.calls[1] = np.minimum(self.calls[1], false_alarms)

    def weights(self) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-odds of good: before any call, for a labeller's call, and for its silence."""
        c = self.calls
        return float(np.log((1 - self.bad) / self.bad)), np.log(c[1] / c[0]), np.log((1 - c[1]) / (1 - c[0]))

    def good(self, patterns: np.ndarray) -> np.ndarray:
        prior, call, silence = self.weights()
        return 1 / (1 + np.exp(-(prior + patterns @ call + (1 - patterns) @ silence)))

    def column(self, v: Column) -> Column:
        """The posterior of good as an expression over the struct of votes."""
        prior, call, silence = self.weights()
        log = F.lit(prior)
        for k, name in enumerate(LABELLERS):
            log = log + F.when(v[name], float(call[k])).otherwise(float(silence[k]))
        return 1 / (1 + F.exp(-log))


def voted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` and the struct ``votes``."""
    step = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    step = step.withColumn("s", F.struct(*[v.alias(k) for k, v in statistics(F.col("text")).items()]))
    held = F.get(F.transform(F.array("s"), lambda s: F.struct(*[F.coalesce(v, F.lit(False)).alias(k) for k, v in votes(s).items()])), 0)
    return step.select("doc_id", "text", held.alias("votes"))


def estimate(rows: DataFrame, rounds: int = EM_ROUNDS) -> Accuracies:
    """The labellers' accuracies from the counted patterns of all documents."""
    counted = rows.groupBy("votes").count().select("votes.*", "count").collect()  # 2^labellers rows at most
    patterns = np.array([[r[k] for k in LABELLERS] for r in counted], int).reshape(-1, len(LABELLERS))
    order = np.lexsort(patterns.T) if len(patterns) else []
    return Accuracies(patterns[order], np.array([r["count"] for r in counted], float)[order], rounds)


def with_buckets(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``b``, the bucket of each word: its shape, and whether it repeats the word before; and ``repeats``."""
    step = df.withColumns({"__w": words_of(F.col("text")), "__s": shapes(F.col("text"))})
    w = F.col("__w")
    again = lambda i: F.coalesce(F.get(w, i) == F.get(w, i - 1), F.lit(False))
    b = F.transform("__s", lambda s, i: F.pmod(F.xxhash64(s, again(i)), F.lit(buckets)).cast("int"))
    # both arrays are used twice, so that neither is inlined into the lambda
    step = step.withColumn("b", F.when(F.size("__s") == F.size("__w"), b))
    return step.withColumn("repeats", F.array(*repeats(w, F.col("text")))).drop("__w", "__s")


def repeats(w: Column, text: Column) -> list[Column]:
    """By ``REPEATS``, what a text has said before: 0 for nothing, near 1 for hardly anything else."""
    n = F.size(w)
    windows = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, WINDOW)]))  # the last ones are shorter
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    seen = lambda a: F.get(F.transform(F.array(a), lambda x: F.size(x) - F.size(F.array_distinct(x))), 0)
    held = F.get(F.transform(F.array(lines), lambda x: (F.size(x) - F.size(F.array_distinct(x))) / (F.size(x) + F.lit(1))), 0)
    # the number of different words grows more slowly than the text, so it is judged against the square root
    expected = F.least(n + PAD, 4 * F.sqrt((n + PAD).cast("double")))
    return [F.greatest(F.lit(0.0), 1 - (F.size(F.array_distinct(w)) + PAD) / expected), seen(windows) / (n + PAD), held]


def fit_scorer(docs: DataFrame, labels: Accuracies, sample: int = SAMPLE, buckets: int = BUCKETS) -> tuple[float, list[float]]:
    """Bias and weights of a logistic scorer of the share of words in each bucket and of ``REPEATS``, learnt from soft labels.

    ``docs`` has ``doc_id`` and ``text``.  About ``sample`` different rows, all
    if there are fewer, are chosen by a hash of id and text, and only they are
    voted on here; at most their number times ``buckets`` counts come to the driver.
    """
    rows = docs.count()
    edge = -(1 << 63) + ((1 << 64) * sample // max(rows, sample)) - 1
    drawn = docs.filter((F.length("text") > 0) & (F.xxhash64("doc_id", "text") <= F.lit(edge)))
    chosen = voted(drawn.distinct())
    counted = with_buckets(chosen, buckets).select(F.xxhash64("doc_id", "text").alias("row"), labels.column(F.col("votes")).alias("y"), "repeats", F.explode_outer("b").alias("b")).filter("b is not null")
    got = counted.groupBy("row", "b").agg(F.count("*").alias("n"), F.first("y").alias("y"), F.first("repeats").alias("repeats")).collect()
    names = {r: i for i, r in enumerate(sorted({g["row"] for g in got}))}
    if not names:
        return 0.0, [0.0] * (buckets + len(REPEATS))
    x, y, more = np.zeros((len(names), buckets)), np.zeros(len(names)), np.zeros((len(names), len(REPEATS)))
    for g in got:
        i = names[g["row"]]
        x[i, g["b"]], y[i], more[i] = g["n"], g["y"], g["repeats"]
    x = np.hstack([x / (x.sum(axis=1, keepdims=True) + PAD), more])
    w, b = np.zeros(x.shape[1]), 0.0
    # a text full of repeats has a long vector: never a step beyond which the fit would swing
    held = np.hstack([x, np.ones((len(y), 1))])
    step = min(STEP, 4 / float(np.linalg.eigvalsh(held.T @ held / len(y))[-1]))
    for _ in range(FIT_ROUNDS):
        e = y - 1 / (1 + np.exp(-(x @ w + b)))
        w += step * (x.T @ e / len(y) - PENALTY * w)
        b += step * e.mean()
    return float(b), w.tolist()


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP, sample: int = SAMPLE, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, weak, score, kept`` per input row: the posterior of the votes, the scorer's probability and the verdict.

    A text without words (null counts as empty) has no features: its posterior
    is its score.  Null ids and repeated rows give a row each; other columns
    are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = voted(docs)
    labels = estimate(rows)
    bias, weights = fit_scorer(docs, labels, sample, buckets)
    step = with_buckets(rows.select("doc_id", "text", labels.column(F.col("votes")).alias("weak")), buckets)
    total = F.aggregate("b", F.lit(0.0), lambda acc, k: acc + F.get(F.lit(weights[:buckets]), k))
    said = sum((F.get("repeats", k) * weights[buckets + k] for k in range(len(REPEATS))), F.lit(bias))
    raw = F.when(F.size("b") > 0, total / (F.size("b") + PAD) + said)
    step = step.withColumn("score", F.coalesce(1 / (1 + F.exp(-raw)), F.col("weak")))
    return step.select("doc_id", "weak", "score", (F.col("score") >= keep).alias("kept"))


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))
