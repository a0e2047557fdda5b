"""Documents that hold the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""
from __future__ import annotations

import random

import pytest

WORDS = "the of and harbour lantern quiet river stone market window paper garden winter copper signal bridge morning engine valley answer".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    out = []
    while n > 0:
        k = min(n, r.randint(6, 14))
        out.append(" ".join(r.choice(WORDS) + str(r.randint(0, 99)) * (r.random() < 0.0) for _ in range(k)).capitalize() + ".")
        n -= k
    return " ".join(out)


def unlike(seed: int, n: int) -> str:
    """Prose of words that hardly recur."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9))) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + 12]).capitalize() + "." for i in range(0, n, 12))


TEXTS = {
    0: unlike(1, 120), 1: unlike(1, 120), 2: unlike(1, 119) + " Extra.", 3: None, 4: "", 5: "   \n\t ", 6: "one two", 7: "One TWO",
    8: unlike(2, 300), 9: "word " * 400, 10: "x" * 20_000, 11: unlike(3, 9000), 12: "Ünïcode äöü ÀÉ ñandú \U0001F600 emoji text.", 13: unlike(4, 60),
    14: "Same line here.\nSame line here.\nOther line.\n\nSame line here.", 15: "a b c d a b c e a b c",
}


@pytest.fixture()
def docs(spark):
    """``documents`` with extra columns that clash with internal and output names."""
    rows = [(i, t, "en", None if i % 5 == 0 else f"src{i % 3}", None if t is None else len(t), "x", 1) for i, t in TEXTS.items()]
    rows += [rows[1], (None, "No id here, but words.", "en", "src0", 22, "x", 1), (40, "Tie one.", "en", "src1", 8, "x", 1), (40, "Tie two.", "en", "src1", 8, "x", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, size int").repartition(3)


@pytest.fixture()
def nothing(docs):
    return docs.filter("doc_id = -1")
