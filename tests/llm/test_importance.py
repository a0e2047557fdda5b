"""Features, gains, weights and the draw against plain Python, for one- and two-word features."""
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tickwise.llm import importance as I

SPLIT = re.compile("[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, longest):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in SPLIT.split(lower) if w]
    return [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)], len(words)


def plain_resample(docs, target, longest, buckets, seed, percent, least):
    place = lambda f: zlib.crc32(f.encode()) % buckets
    raw, aim = Counter(), Counter()
    for _, t in docs:
        raw.update(map(place, plain_features(t, longest)[0]))
    for t in target:
        aim.update(map(place, plain_features(t, longest)[0]))
    s_all, t_all = sum(raw.values()) + buckets, sum(aim.values()) + buckets
    out = []
    for d, t in docs:
        f, words = plain_features(t, longest)
        gain = [math.floor(1000 * math.log((aim[b] + 1) * s_all / ((raw[b] + 1) * t_all))) for b in map(place, f)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, len(f), words, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((r for r in out if r[2] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1]))
    k = percent * len(fit) // 100
    return sorted([(*r, i + 1 if i < k else None) for i, r in enumerate(fit)] + [(*r, None) for r in out if r[2] < least], key=str)


@pytest.mark.parametrize("longest, least, percent", [(1, 20, 50), (2, 2, 30), (3, 0, 100)])
def test_against_plain_python(spark, docs, longest, least, percent):
    target = ["The quiet RIVER and the lantern", None, "", "one two one two three"]
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = I.resample(docs, aim, longest=longest, buckets=97, seed=5, percent=percent, least_words=least)
    want = plain_resample([(r.doc_id, r.text) for r in docs.collect()], target, longest, 97, 5, percent, least)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_features_keep_to_their_text():
    texts = ["a b", "b", "", "--", "É É2 x_y\x00z", "B"]
    bucket, row, words = I.features(pa.array(texts), 2, 10**9)
    for i, t in enumerate(texts):
        f, n = plain_features(t, 2)
        assert sorted(bucket[row == i].tolist()) == sorted(zlib.crc32(x.encode()) % 10**9 for x in f)
        assert words[i] == n


def test_ranks_over_many_parts(spark):
    rows = [(i % 700, 30, 30, 0, 100 if i % 3 == 0 else i % 41) for i in range(2000)]
    scored = spark.createDataFrame(rows, "doc_id bigint, n_features bigint, n_words bigint, weight bigint, score bigint").repartition(7)
    got = I.draw(scored, percent=45, sort_rows=100).collect()
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 901))
    assert [(r.score, r.doc_id) for r in drawn] == [(r[4], r[0]) for r in sorted(rows, key=lambda r: (-r[4], r[0]))[:900]]
    assert len(got) == 2000


def test_nothing(nothing, docs):
    assert I.resample(nothing, docs.select("text")).collect() == []
    assert I.resample(docs, nothing.select("text")).count() == docs.count()
    assert (I.gains(np.zeros(5, np.int64), np.zeros(5, np.int64)) == 0).all()
