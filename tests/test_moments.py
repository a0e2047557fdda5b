"""Mergeable moments against numpy and pandas: missing values, constant columns, hot and empty groups, PCA by its eigen equation."""
import numpy as np
import pandas as pd
import pytest

from tickwise.operators import metrics as M
from tickwise.operators import pca as PC
from tickwise.operators.moments import Moments, grouped_moments

COLS = ["a", "b", "c", "d", "e"]


def numbers(n, seed, holes=0.0):
    r = np.random.default_rng(seed)
    x = r.normal(0, 1, (n, 5)) @ r.normal(0, 1, (5, 5)) * [1, 1e-3, 5, 1, 1] + [1e6, 3, 0, 0, 0]
    x[:, 3] = 7.7
    x[r.random(x.shape) < holes] = np.nan
    return x


def merged(x, size):
    parts = [Moments.of(x[a:a + size]) for a in range(0, len(x), size)]
    out = parts[0]
    for p in parts[1:]:
        out = out.merge(Moments.unpack(p.rows, p.pack(), x.shape[1]))
    return out


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_merging_blocks(size):
    x = numbers(500, 1)
    m = merged(x, size)
    assert np.allclose(m.products / 500, np.cov(x.T, bias=True), rtol=1e-9, atol=1e-12) and not m.products[3].any()
    y = numbers(500, 2, holes=0.2)
    y[:30] = numbers(30, 3)
    y[100:200, 2] = np.nan
    assert np.allclose(merged(y, size).correlation(), pd.DataFrame(y).corr().fillna(0.0), atol=1e-8)


def frame(spark, x, keys):
    return spark.createDataFrame([(k, *[None if np.isnan(v) else float(v) for v in r]) for k, r in zip(keys, x)],
                                 "ticker string, " + ", ".join(f"{c} double" for c in COLS)).repartition(5)


def test_correlation_of_groups_with_missing_values(spark):
    x = numbers(900, 4, holes=0.1)
    keys = ["hot"] * 600 + ["x", None] * 150
    got = {}
    for r in M.correlation_long(frame(spark, x, keys), COLS).collect():
        got.setdefault(r.ticker, {})[r.a, r.b] = r["corr"]
    for key in ("hot", "x", None):
        want = pd.DataFrame(x[[k == key for k in keys]], columns=COLS).corr().fillna(0.0)
        assert len(got[key]) == 25
        assert all(abs(got[key][a, b] - want.loc[a, b]) < 1e-8 for a in COLS for b in COLS)
    whole = x[~np.isnan(x).any(axis=1) & (np.array(keys, dtype=object) == "hot")]
    want = pd.DataFrame(whole, columns=COLS).corr().fillna(0.0)
    for r in M.correlation_complete_case(frame(spark, x, keys), COLS).where("ticker = 'hot'").collect():
        assert abs(r["corr"] - want.loc[r.a, r.b]) < 1e-8
    assert M.correlation_long(frame(spark, x[:0], []), COLS).collect() == []


def test_many_and_several_keys(spark):
    df = spark.range(0, 30_000).selectExpr("id % 6000 as k", "cast(id % 2 as string) as s", "cast(id as double) as a", "cast(id * id % 11 as double) as b")
    got = grouped_moments(df, ["a", "b"], ["k", "s"], "n bigint, mean_a double", lambda key, m: [(m.rows, float(m.mean[0]))])
    want = df.groupBy("k", "s").agg({"a": "avg"}).collect()
    assert sorted((r.k, r.s, r.mean_a) for r in got.collect()) == sorted((r.k, r.s, r["avg(a)"]) for r in want)
    whole = grouped_moments(df, ["a", "b"], [], "n bigint, mean_a double", lambda key, m: [(m.rows, float(m.mean[0]))]).collect()
    assert [(r.n, r.mean_a) for r in whole] == [(30_000, pytest.approx(14999.5))]


def test_components_solve_the_eigen_equation(spark):
    x = numbers(400, 5)
    rows = spark.createDataFrame([("A" if i % 2 else "B", *map(float, r)) for i, r in enumerate(x)], "ticker string, " + ", ".join(f"{c} double" for c in COLS))
    rows = rows.selectExpr("ticker", "date'2020-01-01' as date", *COLS)
    meta, _ = PC.fit_pca(rows, COLS, 5)
    for r in meta.collect():
        mine = x[1::2] if r.ticker == "A" else x[::2]
        z = (mine - mine.mean(axis=0)) / np.where(mine.std(axis=0) > 0, mine.std(axis=0), 1)
        c, v = z.T @ z / len(z), np.array(r.components)
        values = np.array(r.explained_variance_ratio) * 4  # the constant column has no share
        assert r.feature_order == ["a", "b", "c", "e"] and r.n_components == 4
        assert np.allclose(c @ v.T, v.T * values, atol=1e-8) and np.allclose(v @ v.T, np.eye(4), atol=1e-9)
        assert (v[np.arange(4), np.abs(v).argmax(axis=1)] > 0).all()
