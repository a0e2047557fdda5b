"""Ids and decoded texts against the library itself, chunk borders, hot groups and awkward rows."""
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tickwise.llm import chunk_bpe as C


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(C.tokenizer_path())


@pytest.fixture(scope="module")
def model():
    return C.ChunkTokenizer(C.tokenizer_path())


def by_chunks(model, texts, **sizes):
    data, offsets = C._texts(pa.array(texts, pa.large_string()))
    raw = data.tobytes()
    return [[raw[p:q].decode() for p, q in zip([a, *e], e)] for e, a in zip(C.cuts(data, offsets, **sizes), offsets.tolist())]


PARTS = ["'s", "'ll", "'", "'r", "e", "  ", " ", "\n", "\t", "a", "b", "é", "12", "²", "...", "<|endoftext|>", "<|endo", "中文", "😀", "don't ", "x" * 30, "   ", "'ve", "́", "\x1c", "\x00", "हिन्दी", " ", " "]


@pytest.mark.parametrize("sizes", [dict(mean=4, least=1, most=8), dict(mean=16, least=4, most=40), dict(mean=4, least=1, most=4)])
def test_joins_agree_with_the_library_wherever_the_cuts_fall(model, library, sizes):
    r = random.Random(3)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    for text, chunks in zip(texts, by_chunks(model, texts, **sizes)):
        assert "".join(chunks) == text
        ids = model.encode(chunks)
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert model.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


def test_equal_passages_become_equal_chunks_and_are_encoded_once(library):
    r = random.Random(5)
    passage = " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(1500))
    model = C.ChunkTokenizer(C.tokenizer_path())
    texts = [f"{'start ' * k} {passage} {'end ' * k}" for k in range(1, 9)]
    chunks = by_chunks(model, texts)
    shared = set(chunks[0]) & set(chunks[-1])
    assert len("".join(shared)) > 0.8 * len(passage)
    for c in chunks:
        model.encode(c)
    assert model.encoded <= len({x for c in chunks for x in c})


def test_half_of_a_character_decodes_as_in_the_library(model, library):
    ids = library.encode("😀é", add_special_tokens=False).ids[1:]
    assert model.decode(np.array(ids, "<u4").tobytes()).decode() == library.decode(ids, skip_special_tokens=False)


def test_documents_against_the_library(docs, library):
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    got = C.encode_documents(docs, with_ids=True).collect()
    assert len(got) == docs.count()
    assert {(r.doc_id, r.decoded) for r in got} == {(d, t or "") for d, t in texts}
    for r in got:
        want = library.encode(r.decoded, add_special_tokens=False).ids
        raw = np.array(want, "<u4").tobytes()
        assert (r.n_tokens, bytes(r.ids)) == (len(want), raw)
        assert r.ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()


def test_a_hot_group_of_copies_is_split_and_others_stay_together(spark):
    copies = spark.range(400).selectExpr("id as doc_id", "repeat('one text that everyone copies again ', 200) as text")
    few = spark.range(400, 440).selectExpr("id as doc_id", "repeat(concat('pair ', cast(id div 2 as string), ' '), 300) as text")
    from pyspark.sql import functions as F

    rows = C.gather(copies.union(few), task_bytes=200_000, split=64).withColumn("p", F.spark_partition_id())
    spread = rows.groupBy((F.col("doc_id") < 400).alias("hot"), F.when(F.col("doc_id") >= 400, F.expr("doc_id div 2")).alias("k")).agg(F.countDistinct("p").alias("n")).collect()
    assert [r.n for r in spread if r.hot][0] > 4
    assert all(r.n == 1 for r in spread if not r.hot)
    assert rows.count() == 440


def test_nothing(nothing):
    assert C.encode_documents(nothing).collect() == []
