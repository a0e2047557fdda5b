import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tickwise.llm import packing as K


def check_places(rows, cap=4096, documents=10**9, attention=10**18):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for group in by.values():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= cap and len(group) <= documents and sum(r.length ** 2 for r in group) <= attention
    return len(by)


def test_ids_are_the_tokenizers(docs):
    whole = Tokenizer.from_file(K.tokenizer_path())
    odd = ["a<|endoftext|>b", "Σας ΟΔΟΣ", "x\x1cz\x85q  r", "İstanbul ﬁ é́ ́x", "it's we'll 12345 a's", "ÀÉÜßÿ abc!!! éèñ¿ ª º µ A.B a|b", "…”quoted“ naïve, café.###", "日本 語", "x" * 5000 + " y"]
    texts = [r.text or "" for r in docs.collect()] + odd
    own = K.WordTokenizer(K.tokenizer_path())
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_pieces_rebuild_the_documents(docs, nothing):
    whole = Tokenizer.from_file(K.tokenizer_path())
    got = K.pack_documents(docs).collect()
    texts = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    assert K.pack_documents(nothing).count() == 0
    lengths = {}
    for doc, text in texts:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for i, a in enumerate(range(0, len(ids), 4096)):
            lengths.setdefault((doc, i, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes())), []).append(1)
    want = sorted((str(k), len(v)) for k, v in lengths.items())
    seen = {}
    for r in got:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        seen[key] = seen.get(key, 0) + 1
    assert sorted((str(k), v) for k, v in seen.items()) == want
    n = check_places(got)
    assert n == -(-sum(r.length for r in got) // 4096) or n <= 1.1 * sum(r.length for r in got) / 4096 + 1


@pytest.mark.parametrize("rule", ["dot", "norm"])
def test_every_capacity_holds_and_few_bins_are_used(rule):
    r = np.random.default_rng(5)
    lengths = -np.sort(-np.minimum(r.lognormal(5.5, 1.0, 3000).astype(int) + 1, 4095))
    for caps in ((4096, 10**6, 4096**2), (4096, 5, 4096**2), (4096, 40, 4096**2 // 2)):
        ok = lengths[lengths ** 2 <= caps[2]]
        bins = K.best_fit(ok, caps, K.WEIGHTS, rule)
        sums = np.bincount(bins, ok)
        assert sums.max() <= caps[0] and np.bincount(bins).max() <= caps[1] and np.bincount(bins, ok.astype(float) ** 2).max() <= caps[2] * (1 + 1e-9)
        bound = max(ok.sum() / caps[0], len(ok) / caps[1], (ok.astype(float) ** 2).sum() / caps[2])
        assert len(sums) <= 1.15 * bound + 2


def test_tight_limits_through_spark(spark):
    rows = spark.createDataFrame([(i, 0, 0, 1 + i * 37 % 900, i) for i in range(500)], "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    got = K.pack(rows, max_documents=3, max_attention=1_500_000, group_pieces=100).collect()
    assert len(got) == 500
    check_places(got, 4096, 3, 1_500_000)
    with pytest.raises(ValueError):
        K.pack(rows, rule="first")
