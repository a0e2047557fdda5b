"""URL filter: rules first, then naive Bayes over segmented hosts and paths.

Concatenated names in a host are split into words by a unigram Viterbi search;
host words and path words together are scored by a multinomial naive Bayes
model over word stems.  A url whose words name a blocked topic, in any
inflection, is a blocked example; one that names an ordinary topic only is an
allowed one.  All others are unlabelled: they start as allowed, and in a few
rounds of expectation-maximisation count for each class by their posterior, so
that a blocked topic's other words aren't held to be good.  Every distinct
(host, path words) counts once, so a host with very many pages weighs no more
than its words.

Scale: stems go to a fixed number of hash buckets, so the model is an array of
bounded size however many words the corpus has; its counts are one partial
aggregate a round over the distinct rows.  The words are cut once, into the
shared folder; scoring happens inside the row.
"""
from __future__ import annotations

import functools
import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import cut, ship, table
from tickwise.llm.secrets import ranked_words, vocabulary_path

#: (verdict, host, path): a rule fits its host and all subdomains if the url's path starts with its path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Words of blocked topics, the seeds of the blocked class; any inflection of them counts.
SEEDS = (
    "ads", "adserver", "adult", "bet", "bingo", "bonus", "casino", "cheap", "cialis", "crack", "dating", "escort", "farm", "free", "gambling", "hacked", "hentai",
    "jackpot", "keygen", "loan", "lottery", "malware", "nude", "odds", "payday", "phishing", "pills", "piracy", "poker", "porn", "replica", "roulette", "sex",
    "sexy", "slots", "spam", "torrent", "track", "viagra", "wager", "warez", "webcam", "win", "xxx",
)
#: Seeds that alone are ordinary words count only beside another seed.
WEAK_SEEDS = ("cheap", "farm", "free", "bonus", "bet", "track", "dating", "loan", "crack", "hacked", "odds", "slots", "webcam", "replica", "win")
#: Words of ordinary topics, the seeds of the allowed class.
ORDINARY = (
    "archive", "book", "church", "city", "college", "cooking", "council", "garden", "government", "health", "history", "hospital", "journal", "kitchen", "law", "library", "museum",
    "music", "news", "park", "recipe", "research", "school", "science", "sport", "theatre", "travel", "university", "weather", "wiki",
)
#: Host parts without meaning.
PLAIN = ("www", "m", "com", "net", "org", "co", "example", "html", "htm", "php")
BUCKETS = 4096
SMOOTHING = 10.0
#: Log-odds from which a url is blocked.
THRESHOLD = 0.0
#: Rounds in which unlabelled urls count for the classes by their posterior.
ROUNDS = 3
LONGEST_WORD = 20
UNKNOWN_PER_LETTER = 2.5


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for a url without ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    u = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(u, shape, 1), upper, lower), F.regexp_extract(u, shape, 2)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later ones are longer and win
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def viterbi(name: str, words: dict[str, float]) -> list[str]:
    """The most probable split of a name into words; ``words`` gives costs (negative logarithms of probabilities)."""
    best, back = [0.0], [0]
    for i in range(1, len(name) + 1):
        options = []
        for j in range(max(0, i - LONGEST_WORD), i):
            cost = words.get(name[j:i])
            options.append((best[j] + (UNKNOWN_PER_LETTER * (i - j) + 6.0 if cost is None else cost), j))
        b, j = min(options)
        best.append(b)
        back.append(j)
    out, i = [], len(name)
    while i:
        out.append(name[back[i]:i])
        i = back[i]
    return out[::-1]


def stem(word: str) -> str:
    """A word without its inflection: plurals, -er, -ing and -ed, doubled consonants, a last e or y."""
    for end in ("ings", "ing", "ers", "er", "ed", "ies", "es", "s"):
        least = 3 if end in ("ies", "es", "s") else 4
        if word.endswith(end) and not word.endswith("ss") and len(word) - len(end) >= least:
            word = word[:-len(end)] + ("y" if end == "ies" else "")
            break
    if len(word) > 3 and word[-1] == word[-2] and word[-1] not in "aeilosu":
        word = word[:-1]
    if len(word) > 3 and word[-1] == "e":
        return word[:-1]
    return word[:-1] + "i" if len(word) > 3 and word[-1] == "y" else word


def inflected(seed: str) -> list[str]:
    """A seed and the forms that compounds may hold."""
    base = stem(seed)
    return [seed, *[base + end for end in ("s", "es", "er", "ers", "ing", "ed") if stem(base + end) == base]]


def costs(path: str) -> dict[str, float]:
    """Negative decimal logarithms of Zipf probabilities by rank, with the seeds, which compounds are made of, near the top."""
    ranks = ranked_words(path)
    scale = math.log10(sum(1 / (k + 2) for k in range(len(ranks))))
    found = {w: r + scale for w, r in ranks.items()}
    forms = {w: 4.0 for seed in SEEDS for w in inflected(seed)} | dict.fromkeys(SEEDS, 3.0)
    return found | {w: min(found.get(w, 9.0), c) for w, c in forms.items()}


@functools.lru_cache(maxsize=4)
def _segmenter(path: str):
    words = costs(path)
    split = lambda name: tuple(viterbi(name, words))
    held = functools.lru_cache(maxsize=100_000)(split)
    return lambda name: held(name) if len(name) <= 64 else split(name)  # long names hardly recur


def segment(host: str, path: str, vocabulary: str) -> list[str]:
    """Words of host and path, as ``h:word`` and ``p:word``; plain host parts and digits are left out."""
    cut_, out = _segmenter(vocabulary), []
    for side, names in (("h", host), ("p", path.lower())):
        for name in re.findall(r"[^\W\d_]+", names):
            if name not in PLAIN:
                out += [f"{side}:{w}" for w in cut_(name)]
    return out


def with_words(pages: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``pages`` (``host``, ``path``) with the arrays ``words`` and ``stems``."""
    vocabulary = vocabulary or vocabulary_path()
    ship(pages.sparkSession)

    @F.pandas_udf("words array<string>, stems array<string>")
    def words(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [segment(h, p, vocabulary) for h, p in zip(host, path)]
        return pd.DataFrame({"words": found, "stems": [[w[:2] + stem(w[2:]) for w in ws] for ws in found]})

    return pages.withColumn("__cut", words("host", "path")).select(*pages.columns, "__cut.words", "__cut.stems")


def seeded(stems: Column) -> Column:
    """1 if the stems name a blocked topic (a strong seed, or two different weak ones), 0 if an ordinary one only, else null."""
    both = lambda seeds: F.array(*[F.lit(f"{s}:{w}") for w in sorted({stem(x) for x in seeds}) for s in "hp"])
    bare = lambda found: F.array_distinct(F.transform(found, lambda w: F.substring(w, 3, 2**31 - 1)))
    strong = both(x for x in SEEDS if x not in WEAK_SEEDS)
    hints = F.size(bare(F.array_intersect(stems, both(WEAK_SEEDS))))
    bad = F.arrays_overlap(stems, strong) | (hints >= 2)
    return F.when(bad, 1.0).when((hints == 0) & F.arrays_overlap(stems, both(ORDINARY)), 0.0)


def log_odds(stems: Column, prior: float, weights: list[float]) -> Column:
    """The model's log-odds of blocking."""
    table_ = F.lit(weights)
    return F.aggregate(stems, F.lit(float(prior)), lambda acc, w: acc + F.get(table_, F.pmod(F.xxhash64(w), F.lit(len(weights))).cast("int")))


def train(pages: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING, rounds: int = ROUNDS) -> tuple[float, list[float]]:
    """Prior and per-bucket log-odds of the blocked class, from the distinct (host, stems) of all pages."""
    rows = cut(pages.select("host", "stems").distinct().withColumn("known", seeded(F.col("stems"))))

    def fitted(bad: Column) -> tuple[float, list[float]]:
        part = rows.withColumn("bad", F.coalesce("known", bad))
        # the row's own bucket is -1: one aggregate gives the classes and their words
        where = F.concat(F.array(F.lit(-1)), F.transform("stems", lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int")))
        counts = (part.select("bad", F.explode(where).alias("b")).groupBy("b")
                  .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")).collect())  # a row per bucket and one at most
        classes = next((r for r in counts if r["b"] < 0), {"bad": 0.0, "good": 0.0})
        words = [r for r in counts if r["b"] >= 0]
        bad_all, good_all = (sum(r[k] for r in words) for k in ("bad", "good"))
        weights = [0.0] * buckets
        for r in words:
            # smoothed towards the bucket's share of all words, so that a rare word of the larger class doesn't speak for the smaller
            share = smoothing * (r["bad"] + r["good"] + 1) / (bad_all + good_all + buckets)
            weights[r["b"]] = math.log((r["bad"] + share) / (bad_all + smoothing)) - math.log((r["good"] + share) / (good_all + smoothing))
        return math.log((classes["bad"] + 1) / (classes["good"] + 1)), weights

    model = fitted(F.lit(0.0))
    for _ in range(rounds):
        model = fitted(F.round(1 / (1 + F.exp(-log_odds(F.col("stems"), *model))), 9))
    return model


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, vocabulary: str | None = None, threshold: float = THRESHOLD, buckets: int = BUCKETS, rounds: int = ROUNDS) -> DataFrame:
    """The contract's rows, one per input row, with the ``words`` and the ``score`` (log-odds of blocking).

    A null url, or one without ``://``, has no host, path or words: no rule
    fits and the prior decides.  Null ids and repeated rows give a row each;
    other columns are ignored; names of any length are split whole; an empty
    table gives no rows.
    """
    host, path = parts(F.col(url_col))
    rows = cut(with_words(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")), vocabulary))
    score = log_odds(F.col("stems"), *train(rows, buckets, rounds=rounds))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") > threshold, "block").otherwise("allow")
    return rows.withColumn("score", score).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "words", "score")


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
