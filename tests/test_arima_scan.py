"""The CSS scan over blocks against the plain recursion: any block length, a long series over many tasks, skipped tickers."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwise.operators import forecast as FC
from tickwise.session import materialize


def plain_css(d, phi, theta):
    e, out = 0.0, []
    for k in range(1, len(d)):
        e = d[k] - phi * d[k - 1] - theta * e
        out.append(e)
    return np.array(out)


def plain_fit(levels):
    d = np.diff(levels)
    best = (0.0, 0.0)
    for half, denom in ((19, 20.0), (10, 200.0), (10, 2000.0)):
        steps = (np.arange(2 * half + 1) - half) / denom
        best = min((float((plain_css(d, p, t) ** 2).sum()), p, t) for p in best[0] + steps if abs(p) < 1 for t in best[1] + steps if abs(t) < 1)[1:]
    return best


def walk(n, seed):
    r = np.random.default_rng(seed)
    e, d = r.normal(0, 1, n), np.zeros(n)
    for t in range(1, n):
        d[t] = 0.5 * d[t - 1] + e[t] + 0.3 * e[t - 1]
    return 100 + np.cumsum(d)


@pytest.fixture(scope="module")
def series(spark):
    lengths = {"A": 90, "B": 3, "C": 4, "D": 17, "E": 2, "F": 1}
    data = {k: walk(n, i) for i, (k, n) in enumerate(lengths.items())}
    return data, spark.createDataFrame([(k, t, float(x)) for k, v in data.items() for t, x in enumerate(v)], "ticker string, t bigint, v double").cache()


def test_blocks_hold_every_difference_once(series):
    data, levels = series
    for block in (3, 4, 8, 1000):
        rows = FC.series_blocks(levels, block).orderBy("ticker", "block").collect()
        for k, v in data.items():
            mine = [r for r in rows if r.ticker == k]
            assert [x for r in mine for x in r.d] == np.diff(v)[1:].tolist()
            assert all(len(r.d) <= block for r in mine)


@pytest.mark.parametrize("block", [5, 4096])
def test_fit_is_that_of_the_plain_recursion(series, block):
    data, levels = series
    got = {r.ticker: r for r in FC.fit_levels(levels, block).collect()}
    assert sorted(got) == ["A", "B", "C", "D"]
    for k in ("A", "D"):
        r, d = got[k], np.diff(data[k])
        e = plain_css(d, r.phi, r.theta)
        assert (r.phi, r.theta) == pytest.approx(plain_fit(data[k]))
        assert (r.sse, r.sum_abs, r.last_resid) == pytest.approx(((e ** 2).sum(), np.abs(e).sum(), e[-1]))
        assert (r.n_resid, r.last_diff) == (len(e), pytest.approx(d[-1]))


def test_a_long_series_is_spread_over_tasks(spark):
    n = 60_000
    levels = spark.range(n).select(F.lit("L").alias("ticker"), F.col("id").alias("t"), (F.sin(F.col("id") / 7.0) + F.col("id") % 13 * 0.1).alias("v"))
    levels = materialize(levels)
    blocks = FC.series_blocks(levels, 2048)
    places = blocks.select(F.spark_partition_id().alias("p")).distinct().count()
    assert blocks.count() == -(-n // 2048) and places > 3
    v = np.sin(np.arange(n) / 7.0) + np.arange(n) % 13 * 0.1
    r = FC.fit_levels(levels, 2048).first()
    e = plain_css(np.diff(v), r.phi, r.theta)
    assert r.sse == pytest.approx((e ** 2).sum()) and r.last_resid == pytest.approx(e[-1])


def test_skipped_tickers_are_named_and_have_no_forecast(spark):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    rows = [("A", day(i), float(x)) for i, x in enumerate(walk(40, 9))] + [("S", day(0), 1.0), ("S", day(1), 2.0)]
    fit = FC.fit_arima(spark.createDataFrame(rows, "ticker string, date date, Close double"))
    got = {r.ticker: r for r in fit.collect()}
    assert (got["A"].status, got["S"].status, got["S"].phi, got["S"].last_obs) == ("ok", "skipped", None, 2.0)
    assert {r.ticker for r in FC.forecast(fit, 3).collect()} == {"A"}
