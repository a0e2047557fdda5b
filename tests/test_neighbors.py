"""Exact neighbours through the stored pivot index, and the recommendations by date and by vector."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwise.operators import neighbors as NB
from tickwise.operators import pivot_index as PX


def clustered(n, dims, centres, seed):
    r = np.random.default_rng(seed)
    c = r.normal(0, 20, (centres, dims))
    return c[r.integers(0, centres, n)] + r.normal(0, 1, (n, dims))


def nearest(x, q, k, own=None):
    d = np.sqrt(((x - q) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((np.arange(len(x)), d)) if i != own][:k]
    return [(int(i), round(float(d[i]), 9)) for i in order]


@pytest.mark.parametrize("copies", [0, 700])
def test_index_skips_rows_and_finds_the_same(spark, tmp_path, copies):
    x = clustered(3000, 8, 25, 1)
    x[:copies] = x[0]  # many equal rows
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(9999, None)], "id int, v array<double>")
    PX.build_index(points, str(tmp_path / "index"), "id", "v", pivots=12, shard_rows=100, sample=500)
    asked = [5, 1500, 2999]
    got, seen = PX.search(spark, str(tmp_path / "index"), points.where(F.col("id").isin(asked)), "id", "v", 10)
    got = got.collect()
    for q in asked:
        mine = sorted((r for r in got if r.target == q), key=lambda r: r["rank"])
        assert [(r.key, round(r.distance, 9)) for r in mine] == nearest(x, x[q], 10, q)
    for r in seen.collect():
        assert r.n_rows == 3000 and r.read_shards <= r.n_shards
        assert r.read_rows < 0.5 * r.n_rows


def test_index_of_fewer_rows_than_asked_for_and_of_none(spark, tmp_path):
    points = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(4)], "id int, v array<double>")
    PX.build_index(points, str(tmp_path / "few"), "id", "v")
    got, _ = PX.search(spark, str(tmp_path / "few"), points.where("id = 1"), "id", "v", 10, exclude_self=False)
    assert [(r.key, r["rank"]) for r in got.orderBy("rank").collect()] == [(1, 1), (0, 2), (2, 3), (3, 4)]
    PX.build_index(points.where("id < 0"), str(tmp_path / "none"), "id", "v")
    got, _ = PX.search(spark, str(tmp_path / "none"), points, "id", "v", 3)
    assert got.collect() == []


def test_index_filters_partitions(spark, tmp_path):
    x = clustered(1000, 4, 10, 2)
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>")
    PX.build_index(points, str(tmp_path / "i"), "id", "v", shard_rows=50)
    plan = PX.search(spark, str(tmp_path / "i"), points.where("id = 7"), "id", "v", 5)[0]._jdf.queryExecution().toString()
    assert "PartitionFilters: [shard" in plan.replace("isnotnull(shard", "shard") or "shard#" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_recommendations(spark):
    day = lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i)
    rows = [("A", day(i), [float(i % 7), float(i)]) for i in range(20)] + [("B", day(i), [0.0, float(i)]) for i in range(3)]
    points = spark.createDataFrame(rows, "ticker string, date date, pc array<double>")
    nxt = spark.createDataFrame([("A", day(i), float(i), 0.1 * i if i < 19 else None) for i in range(20)], "ticker string, date date, Close double, next_return double")
    asked = NB.newest_targets(points, "pc", date="2020-01-10")
    got = NB.recommend(points, asked, "pc", nxt, 3).collect()
    a = sorted((r for r in got if r.ticker == "A"), key=lambda r: r["rank"])
    assert {r.target for r in a} == {day(9)} and day(9) not in {r.date for r in a}
    assert {r.target for r in got if r.ticker == "B"} == {day(2)}  # no such day: the newest
    assert [r.next_return for r in got if r.ticker == "B"] == [None, None]
    returns = [r.next_return for r in a]
    assert a[0].mean_next_return == pytest.approx(np.mean(returns)) and a[0].median_next_return == pytest.approx(np.median(returns))
    assert a[0].std_next_return == pytest.approx(np.std(returns))
    vector = spark.createDataFrame([("A", day(19), [2.0, 9.0])], "ticker string, date date, pc array<double>")
    mine = NB.recommend(points, vector, "pc", nxt, 1, exclude_self=False).collect()
    assert [(r.date, r.distance) for r in mine] == [(day(9), 0.0)]
