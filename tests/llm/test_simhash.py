import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tickwise.llm import simhash as S


def slow_fingerprint(text):
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ")
    words = [w for w in words if w]
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """Smallest id reachable per row, over all pairs."""
    label = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for a, (i, x) in enumerate(rows):
            for b, (j, y) in enumerate(rows):
                if (x ^ y).bit_count() <= 3 or i == j:
                    low = min(label[a], label[b])
                    changed |= label[a] != low or label[b] != low
                    label[a] = label[b] = low
    return label


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 63), max_size=3), st.integers(0, 2**64 - 1))
def test_every_pair_within_the_radius_shares_a_bucket(bits, x):
    y = x ^ sum(1 << b for b in bits)
    tables = [v for v, m in enumerate(S.MASKS) if x & m == y & m]
    assert tables
    for v in tables:
        assert any(x & m == y & m for m in S.SUB_MASKS[v])


def test_sub_buckets_are_bounded():
    assert max(64 - m.bit_count() for masks in S.SUB_MASKS for m in masks) <= 16


def test_forest_links_what_brute_force_links():
    r = random.Random(3)
    base = r.getrandbits(64)
    fps = list({base ^ sum(1 << r.randrange(64) for _ in range(2)) for _ in range(60)} | {r.getrandbits(64) for _ in range(30)})
    edges = S.forest(np.array(fps, np.uint64), np.arange(len(fps)))
    root = dict(edges)
    assert [root.get(i, i) for i in range(len(fps))] == slow_components(list(enumerate(fps)))


def test_components_match_brute_force(docs):
    rows = [r for r in docs.collect() if r.doc_id is not None]
    want = slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in rows])
    for group in (S.MAX_GROUP, 2):  # the second spreads every larger bucket
        got = S.near_duplicates(docs, max_group=group).collect()
        assert len(got) == docs.count()
        assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got if r.doc_id is not None) == sorted((r.doc_id, f"{slow_fingerprint(r.text):016x}", c) for r, c in zip(rows, want))


def test_long_chains_are_one_component(spark):
    chain, x = [], 0
    for i in range(21):
        chain.append((S._signed(x), 100 - i))
        x ^= 0b111 << (3 * i)
    df = spark.createDataFrame(chain, "fp bigint, node bigint")
    got = {r.node: r.root for r in S.components(S.links(df)).collect()}
    assert got == {n: 80 for n in range(81, 101)}


def test_keep_one_keeps_the_smallest_of_each(docs, nothing):
    found = S.near_duplicates(docs).collect()
    out = S.keep_one(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({r.component_id for r in found if r.doc_id is not None})
    assert ids.count(None) == 1
    assert S.near_duplicates(nothing).count() == 0 and S.keep_one(nothing).count() == 0
