"""Exact quantiles by rank selection against numpy and Spark's own percentile."""
import math
import random

import numpy as np
import pytest

from tickwise.operators.quantiles import exact_quantile


def rows():
    r = random.Random(3)
    out = [("spread", r.gauss(0, 1)) for _ in range(3000)] + [("skew", math.exp(r.uniform(-300, 300))) for _ in range(1501)]
    out += [("same", 5.0)] * 900 + [("two", float(i % 2)) for i in range(1000)] + [("most", 7.0)] * 950 + [("most", float(i)) for i in range(50)]
    out += [("one", 2.5), ("nulls", None), (None, 1.0), (None, 4.0), ("edge", float("inf")), ("edge", float("-inf")), ("edge", 0.0)]
    return out + [("holes", None if i % 3 else float(i)) for i in range(700)]


@pytest.mark.parametrize("q,group_rows", [(0.8, 0), (0.5, 100)])
def test_selection_matches_numpy(spark, q, group_rows):
    data = rows()
    df = spark.createDataFrame(data, "ticker string, v double").repartition(5)
    got = {r.ticker: r.quantile for r in exact_quantile(df, "v", q, group_rows=group_rows, cuts=8).collect()}
    for t in {t for t, _ in data} - {"edge"}:
        values = [v for k, v in data if k == t and v is not None]
        assert got[t] == pytest.approx(np.quantile(values, q), rel=1e-12) if values else got[t] is None
    assert got["edge"] == (0.0 if q == 0.5 else float("inf")) and len(got) == len({t for t, _ in data})
    assert exact_quantile(df.where("v > 1e300 and ticker = 'x'"), "v", q).count() == 0
