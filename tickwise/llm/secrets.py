"""Secret scan by password guess cost.

Three base patterns give spans outright.  Beside them, the value in any
credential-like context is judged by how many guesses it would take: a dynamic
program finds its cheapest segmentation into dictionary words, dates, repeats,
keyboard walks and brute-force spans, and a value whose cheapest explanation
is still dear is a secret.

Scale: one pass without a shuffle.  Texts without a trace of a key word, an
access prefix or a long hexadecimal run never reach the patterns; the ranked
dictionary is a public vocabulary file of fixed size, read by each worker.
"""
from __future__ import annotations

import hashlib
import json
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import map_rows, table, whole_text

KINDS = ("assign", "access", "hex", "credential")

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # at most one match of 18 or more lies in a run, the first
_HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_CHARS = 12

#: Names that announce a credential; the first letters decide whether a text is searched at all.
#: A name may stand behind any prefix (DB_PASSWORD, dbPassword), the ones that end ordinary words only behind a word edge.
_NAME = r"""(?:password|passwd|passphrase|passcode|pwd|secret|token|api[_\x20-]?key|authorization|credentials?|private[_-]?key|access[_-]?key|client[_-]?secret|encryption[_-]?key|(?:(?<![a-z])|(?<=(?-i:[a-z]))(?=(?-i:[A-Z])))(?:pass|o?auth|bearer))"""
#: What may follow a name: more parts of an identifier, not the rest of another word (author, secretary).
_MORE = r"""(?:(?:[_0-9-]|(?-i:(?<=[a-z])[A-Z]))[a-z0-9_-]{0,64}|key|hash|value|id|s)?"""
#: Words that say how a value is to be used; the credential comes after them.
_SCHEME = r"""(?:(?:bearer|basic|digest|token|apikey|negotiate)\x20+)?"""
_CONTEXT = re.compile(
    rf"""(?ai:{_NAME}{_MORE})["']?(?:\x20*(?:[:=]|=>|:=)\x20*|\x20+is\x20+)(?:(?P<q>["'])(?ai:{_SCHEME})(?P<quoted>[^"'\n]{{6,}})(?P=q)|(?ai:{_SCHEME})(?P<bare>[^\s"']{{6,}}))"""
)
TRACES = ("pass", "pwd", "secret", "token", "api", "auth", "bearer", "credential", "key")

#: A value is a secret from this many decimal digits of guesses.
MIN_LOG_GUESSES = 10.0
#: Guess counts as decimal logarithms: one more segment, one brute-force character by class.
SEGMENT_COST = 0.6
_CLASSES = ((re.compile(r"[0-9]"), 1.0), (re.compile(r"[a-z]"), 1.42), (re.compile(r"[A-Z]"), 1.42), (re.compile(r"[!-~]"), 1.52))
OTHER_COST = 2.0
LONGEST_WORD = 24
#: Rows of a common keyboard, and the order of letters and digits.
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "qazwsxedcrfvtgbyhnujmikolp")
#: The usual substitutions for letters.
_LEET = str.maketrans("4301$57@", "aeoissta")
_DATE = re.compile(r"(?:(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[-/.](?:0?[1-9]|1[0-2])[-/.](?:19|20)?\d\d|(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:19|20)\d\d|(?:19|20)\d\d)")
#: A date is one of so many days; a year alone one of so many years.
DATE_COST, YEAR_COST = 4.6, 2.2


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def ranked_words(path: str) -> dict[str, float]:
    """Decimal logarithm of the rank of each whole word of the vocabulary: its merges stand in order of frequency."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = sorted((i, w[:-4]) for w, i in vocab.items() if w.endswith("</w>") and len(w) > 6 and w[:-4].isalpha())
    return {w: math.log10(rank + 2) for rank, (_, w) in enumerate(words)}


def _walks(value: str) -> dict[int, list[tuple[int, float]]]:
    """For each end, the keyboard walks and sequences of three or more keys that end there, as (start, cost)."""
    low, out = value.lower(), {}
    for row in WALKS:
        for line in (row, row[::-1]):
            at = {c: i for i, c in enumerate(line)}
            start = 0
            for i in range(1, len(low) + 1):
                if i < len(low) and low[i - 1] in at and at.get(low[i]) == at[low[i - 1]] + 1:
                    continue
                for a in range(start, i - 2):
                    for b in range(a + 3, i + 1):
                        if b - a <= len(line):
                            out.setdefault(b, []).append((a, math.log10(2 * len(WALKS) * len(row)) + 0.1 * (b - a)))
                start = i
    return out


def _repeats(value: str) -> dict[int, list[tuple[int, float, int]]]:
    """For each end, the repeats that end there as (start, cost of the count, length of the unit)."""
    out: dict[int, list[tuple[int, float, int]]] = {}
    for unit in range(1, 9):
        run = 0
        for i in range(unit, len(value)):
            run = run + 1 if value[i] == value[i - unit] else 0
            if run and run % unit == 0 and run + unit >= max(3, 2 * unit):
                times = run // unit + 1
                out.setdefault(i + 1, []).append((i + 1 - times * unit, math.log10(times + 1), unit))
    return out


def log_guesses(value: str, words: dict[str, float]) -> float:
    """Decimal logarithm of the guesses of the cheapest segmentation."""
    n = len(value)
    low, leet = value.lower(), value.lower().translate(_LEET)
    each = [next((c for p, c in _CLASSES if p.match(x)), OTHER_COST) for x in value]
    dates: dict[int, list[tuple[int, float]]] = {}
    for a in range(n):
        m = _DATE.match(value, a)
        if m:
            dates.setdefault(m.end(), []).append((a, YEAR_COST if m.end() - a == 4 else DATE_COST))
    walks, repeats = _walks(value), _repeats(value)
    # best[i]: cheapest for the first i characters; brute[i]: the same if a brute-force span ends there
    best, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
    for i in range(1, n + 1):
        brute[i] = min(best[i - 1] + SEGMENT_COST * (i > 1), brute[i - 1]) + each[i - 1]
        cost = brute[i]
        for j in range(max(0, i - LONGEST_WORD), i - 2):
            rank, extra = words.get(low[j:i]), 0.0
            if rank is None:
                rank, extra = words.get(leet[j:i]), 0.3
            if rank is not None:
                if low[j:i] != value[j:i]:
                    extra += 0.3 if value[j:i] in (low[j:i].capitalize(), low[j:i].upper()) else 0.3 * (i - j)
                cost = min(cost, best[j] + SEGMENT_COST * (j > 0) + rank + extra)
        for j, c in dates.get(i, ()):
            cost = min(cost, best[j] + SEGMENT_COST * (j > 0) + c)
        for j, c in walks.get(i, ()):
            cost = min(cost, best[j] + SEGMENT_COST * (j > 0) + c)
        for j, c, unit in repeats.get(i, ()):
            # the unit's own cost is that of having just typed it, then counting
            cost = min(cost, best[j + unit] + SEGMENT_COST + c)
        best[i] = cost
    return best[n]


def base_spans(text: str, low: str | None = None) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base patterns, sorted."""
    low = text.lower() if low is None else low
    out = []
    if any(t in low for t in ("passw", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def all_spans(text: str, words: dict[str, float], min_log_guesses: float = MIN_LOG_GUESSES) -> tuple[list, list]:
    """Base spans, and those with the dear values in credential contexts, unless one base span covers the whole value."""
    low = text.lower()
    base = base_spans(text, low)
    more = []
    if any(t in low for t in TRACES):
        for m in _CONTEXT.finditer(text):
            group = "quoted" if m["quoted"] else "bare"
            a, b = m.span(group)
            while b > a and text[b - 1] in ".,;:!?)]}>" and group == "bare":
                b -= 1  # punctuation of the sentence
            value = text[a:b]
            if len(value) < 6 or any(s <= a and b <= e for s, _, e in base):
                continue
            if log_guesses(value, words) >= min_log_guesses:
                more.append((a, 3, b))
    return base, sorted(base + more)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_WORDS: dict[str, dict[str, float]] = {}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, min_log_guesses: float = MIN_LOG_GUESSES) -> DataFrame:
    """The contract's rows, one per input row.

    Null text is empty and has no spans; null ids and repeated rows give a row
    each; other columns are ignored; an empty table gives no rows.
    """
    path = path or vocabulary_path()

    def run(cols):
        words = _WORDS.get(path) or _WORDS.setdefault(path, ranked_words(path))
        out = [[] for _ in range(6)]
        for text in cols[1]:
            base, spans = all_spans(text, words, min_log_guesses)
            kinds = [k for _, k, _ in base]
            for o, v in zip(out, (*[kinds.count(k) for k in range(3)], hashlib.sha256(written(base).encode()).hexdigest(), written(spans), len(spans) - len(base))):
                o.append(v)
        return [cols[0], *out]

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_credential bigint"
    return map_rows(docs.select(F.col(id_col).cast("bigint"), whole_text(text_col)), schema, run)


def op1_secrets(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
