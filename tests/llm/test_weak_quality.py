import numpy as np

from tickwise.llm import weak_quality as W


def test_estimation_recovers_accuracies():
    r = np.random.default_rng(2)
    n, m = 40_000, len(W.LABELLERS)
    bad = r.random(n) < 0.15
    catch, alarm = np.linspace(0.7, 0.2, m), np.full(m, 0.004)
    calls = (r.random((n, m)) < np.where(bad[:, None], catch, alarm)).astype(int)
    patterns, counts = np.unique(calls, axis=0, return_counts=True)
    model = W.Accuracies(patterns, counts.astype(float))
    assert abs(model.bad - 0.15) < 0.02
    assert np.abs(model.calls[0] - catch).max() < 0.05 and np.abs(model.calls[1] - alarm).max() < 0.004
    assert ((model.good(calls) > 0.5) != bad).mean() > 0.97


def test_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got = W.classify(docs).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").join(docs.selectExpr("doc_id", "n_chars"), "doc_id").collect()
    clean = [r.kept for r in got if r.quality == 1]
    junk = [r.kept for r in got if r.quality == 0]
    assert sum(clean) >= 0.97 * len(clean) and sum(junk) <= 0.15 * len(junk)


def test_awkward_documents(docs, nothing):
    got = W.classify(docs).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.kept == (r.score >= W.KEEP) for r in got)
    assert [r.score == r.weak for r in got if r.doc_id in (3, 4, 5)] == [True] * 3
    assert W.classify(nothing).count() == 0
    assert sorted(map(str, W.classify(docs).collect())) == sorted(map(str, got))


def test_capitals_are_judged_by_letters(spark):
    shouted = "WAR 12 - NEWS 34 : now 56 / " * 12  # 7 of 10 letters are capitals, but only 3 of 10 characters
    plain = "Quiet Rivers 12 - run : now 34 / " * 12
    got = {r.doc_id: r.votes.capitals for r in W.voted(spark.createDataFrame([(1, shouted), (2, plain)], "doc_id bigint, text string")).collect()}
    assert got == {1: True, 2: False}


def test_repetition_reaches_the_scorer(spark):
    from pyspark.sql import functions as F
    from tests.llm.conftest import unlike

    d = "/root/testdata/sf0.01"
    line = "the quiet river runs past the old stone market every morning."
    other = [x.lower() for x in unlike(9, 240).split("\n")]
    rows = [(-1, "\n".join([line] * 20)), (-2, "\n".join(other[:20]))]
    mine = spark.createDataFrame(rows, "doc_id bigint, text string")
    made = {r.doc_id: list(r.repeats) for r in W.with_buckets(mine).collect()}
    assert min(made[-1]) > 0.5 and max(made[-2]) < 0.1
    got = {r.doc_id: r for r in W.classify(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").unionByName(mine)).filter(F.col("doc_id") < 0).collect()}
    assert not got[-1].kept and got[-1].score < got[-2].score
