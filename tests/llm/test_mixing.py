import re

import pytest

from tickwise.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_targets(sizes):
    """Water filling by the definition; ``sizes`` by source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, free, out = M.BUDGET * sum(sizes.values()), set(names), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def rows_of(spark):
    data = [(i, "w " * (1 + i * 7 % 90), ["b", "a", "\U0001F600", "é", "Z", None][i % 6] if i % 3 else "hot") for i in range(900)]
    return spark.createDataFrame(data, "doc_id bigint, text string, source string")


def check(df, got):
    sizes = {}
    for r in df.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
    goals = slow_targets(sizes)
    source = {(r.doc_id, len(WORD.findall(r.text or ""))): r.source for r in df.collect()}
    taken, longest = {}, {}
    for r in got:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and r.target == pytest.approx(goals[s]) and r.taken <= 2 * r.size and r.taken == r.size * len(r.positions)
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
        taken[s] = taken.get(s, 0) + r.taken
        longest[s] = max(longest.get(s, 0), r.size)
    for s in sizes:
        assert abs(taken[s] - goals[s]) <= longest[s]


def test_targets_and_takes(spark, docs):
    df = rows_of(spark)
    got = M.mixing_plan(df).collect()
    assert len(got) == 900
    check(df, got)
    small = M.mixing_plan(df, bucket_rows=20).collect()  # many buckets give the same mix
    assert sorted((r.doc_id, r.taken) for r in small) == sorted((r.doc_id, r.taken) for r in got)
    order = [r.position for r in got if r.position is not None]
    assert order == sorted(order)
    assert M.mixing_plan(docs).count() == docs.count()


def test_awkward_documents(docs, nothing):
    got = M.mixing_plan(docs).collect()
    assert all(r.size == 0 and r.taken == 0 for r in got if r.doc_id in (3, 4, 5))
    assert M.mixing_plan(nothing).count() == 0 and M.mix(nothing).count() == 0
    out = M.mix(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(len(r.positions) for r in got)
    empty = docs.filter("doc_id = 4")
    assert [r.target for r in M.mixing_plan(empty).collect()] == [0.0]


def test_mix_repeats_rows_as_taken(spark):
    df = rows_of(spark)
    plan = {r.doc_id: len(r.positions) for r in M.mixing_plan(df).collect()}
    seen = {}
    for r in M.mix(df).collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: v for k, v in plan.items() if v}


def test_positions_invert_the_integral(spark):
    from pyspark.sql import functions as F

    for a, b in ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5), (0.0, 2.0)):
        df = spark.range(101).select((F.col("id") / 100).alias("q")).withColumn("t", M.position(F.col("q"), F.lit(a), F.lit(b)))
        for r in df.collect():
            steps = 4000
            integral = sum((a + (b - a) * (i + 0.5) / steps * r.t) for i in range(steps)) * r.t / steps
            assert integral / ((a + b) / 2) == pytest.approx(r.q, abs=1e-6)


def test_ranks_are_code_point_order(spark):
    names = [f"s{x}" for x in ("a", "B", "é", "z", "\U0001F600", "￮", "")] + ["z"]
    got = {r["__source"]: r["rank"] for r in M.ranked(spark.createDataFrame([(n, 1) for n in names], "__source string, source_size bigint")).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names))}
