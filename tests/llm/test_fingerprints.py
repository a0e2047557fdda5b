import hashlib

import numpy as np

from tickwise.llm import fingerprints as P
from tickwise.llm.common import NULL_ID


def test_next_and_edited_match_brute_force(docs, nothing):
    rows = [(NULL_ID if r.doc_id is None else r.doc_id, r.text or "") for r in docs.collect()]
    single = [x for x in rows if sum(y[0] == x[0] for y in rows) == 1]
    for ranges in (1, 5, 40):
        got = P.compare_with_next(docs, ranges=ranges).collect()
        assert len(got) == len(rows)
        by = {r.doc_id: r for r in got}
        order = sorted(rows, key=lambda x: x[0])
        for k, (i, text) in enumerate(order):
            after = order[(k + 1) % len(order)]
            if (i, text) in single and after in single:
                half, r = len(text) // 2, by[None if i == NULL_ID else i]
                new = text[:len(text) - half] + after[1][:half]
                assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
                assert r.fingerprint == P.fingerprint(text)[0] and r.edited_fingerprint == P.fingerprint(new)[0]
                assert r.near_next == P.likeness(P.fingerprint(text), P.fingerprint(after[1])) and 0 <= r.near_edited <= 1
    assert by[0].fingerprint == by[1].fingerprint and by[0].near_next == 1.0
    assert P.compare_with_next(nothing).count() == 0


def test_one_document_is_its_own_next(spark):
    df = spark.createDataFrame([(5, "abcdef")], "doc_id bigint, text string")
    row = P.compare_with_next(df).collect()[0]
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and row.near_next == 1.0


def test_estimates_follow_true_containment():
    from tests.llm.conftest import unlike

    whole = P.split_words(unlike(9, 8000))
    for share in (0.1, 0.4, 0.8):
        part = whole[:int(len(whole) * share)]
        a, b = P.sketch(part), P.sketch(whole)
        assert P.containment(a, b) == 1.0 and abs(P.containment(b, a) - share) < 0.06
        assert (P.merged(a, P.sketch(whole[len(part) - 4:])) == b).all()  # halves that overlap by four words merge exactly
    assert len(P.sketch(whole, scale=1)) > 3.5 * len(P.sketch(whole)) > 0
    assert P.sketch([]).dtype == np.uint64 and P.containment(P.sketch([]), b) == 0.0


def test_range_lookup_in_two_levels(spark):
    from pyspark.sql import functions as F

    bounds = sorted({i * 37 % 5000 for i in range(700)})
    got = spark.range(-5, 5100, 13).withColumn("r", P._range_of(F.col("id"), bounds)).collect()
    assert all(r.r == sum(b <= r.id for b in bounds) for r in got)
