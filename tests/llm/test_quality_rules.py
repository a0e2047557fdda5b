import re
from collections import Counter

from tickwise.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often, covered, seen, dup = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_base_columns_match_brute_force(docs):
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    got = Q.judge(docs).collect()
    assert len(got) == docs.count()
    want = sorted((str(i), *counts(t)) for i, t in [(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert texts and not any(r.kept and r.base_failed for r in got)


def test_lines_decide(spark):
    from tests.llm.conftest import unlike

    good, nav = unlike(5, 120), " | ".join(["Home", "News", "Sport"] * 30)
    shout = " ".join(["LOUD!!"] * 8 + [f"W{i}!!" for i in range(80)])
    df = spark.createDataFrame([(1, good), (2, good + "\n" + nav), (3, good + "\nAll rights reserved."), (4, shout), (5, unlike(6, 60).replace(".", ""))], "doc_id bigint, text string")
    kept = {r.doc_id: r.kept for r in Q.judge(df).collect()}
    assert kept == {1: True, 2: False, 3: True, 4: False, 5: False}
    cleaned = {r.doc_id: r.text for r in Q.clean(df).collect()}
    assert cleaned == {1: good, 3: good}


def test_clean_keeps_the_columns_and_counts_characters(docs, nothing):
    out = Q.clean(docs)
    assert out.columns == docs.columns
    assert all(r.n_chars == len(r.text) for r in out.collect())
    assert Q.judge(nothing).count() == 0 and Q.clean(nothing).count() == 0


def test_words_of_a_line_are_runs_of_anything_but_blanks(spark):
    from pyspark.sql import functions as F

    fails = {"Home\tNews\tSport\t|\t|": True, "#\t$\t%\t&": True, "one\ttwo\tthree": True, "    Intro": False, "Intro    ": False, "a    b": False, "#  word   word  #": True,
             "A clean line of words.": False, "    Indented words that end.": False}
    fails |= {"यह एक साफ वाक्य है।": False, "यह एक साफ वाक्य है": True, "یہ ایک صاف جملہ ہے۔": False, "هل هذه جملة واضحة؟": False, "これは 文 です ！": False, "这 是 句子 吗？」": False}
    rows = spark.createDataFrame(list(enumerate(fails)), "i int, x string").select("i", Q.line_fails(F.col("x")).alias("f")).collect()
    assert {r.i: r.f for r in rows} == dict(enumerate(fails.values()))


def test_clean_documents_of_other_scripts_are_kept(spark):
    hindi = "\n".join(f"यह{i} वाक्य साफ{i} और पूरा{i} है।" for i in range(12))
    urdu = "\n".join(f"یہ{i} جملہ صاف{i} اور مکمل{i} ہے۔" for i in range(12))
    got = {r.doc_id: (r.kept, r.lost_chars) for r in Q.judge(spark.createDataFrame([(1, hindi), (2, urdu)], "doc_id bigint, text string")).collect()}
    assert got == {1: (True, 0), 2: (True, 0)}
