"""Rules, PCA, KMeans, ARIMA: invariants and stored-artifact goldens."""
import datetime as dt
import math

import numpy as np
import pandas as pd
from tickwise.operators import cluster as CL
from tickwise.operators import forecast as FC
from tickwise.operators import pca as PC
from tickwise.operators import rules as RU
from tickwise.operators.timeseries import FEATURE_COLUMNS, feature_matrix

# The stored 7-step forecast of the reference's registry.
STORED_LAST = 278.2799987792969
STORED_PRED = [278.285988095162, 278.28806884030763, 278.288791710909, 278.28904284301296,
               278.2891300886881, 278.2891603986633, 278.28917092863617]
STORED_CI = [[272.26194191879716, 284.31003427152683], [269.58660162538325, 286.989536055232],
             [267.5062926800342, 289.07129074178374], [265.7510232871791, 290.8270623988468],
             [264.2079894253654, 292.37027075201087], [262.8165155766644, 293.76180522066215],
             [261.53973792725276, 295.0386039300196]]


def test_forecast_reproduces_stored_artifact(spark):
    d1 = STORED_PRED[0] - STORED_LAST
    phi = (STORED_PRED[1] - STORED_PRED[0]) / d1
    half = [(u - lo) / 2 for lo, u in STORED_CI]
    sigma = half[0] / 1.96
    psi1 = math.sqrt((half[1] / (1.96 * sigma)) ** 2 - 1)
    theta = psi1 - 1 - phi
    fit = spark.createDataFrame([("AAPL", phi, theta, sigma * sigma, STORED_LAST, d1 / phi, 0.0,
                                  dt.date(2025, 12, 12))],
                                "ticker string, phi double, theta double, sigma2 double, last_obs double, "
                                "last_diff double, last_resid double, last_date date")
    got = FC.forecast(fit, 7).orderBy("step").collect()
    for r, p, (lo, hi) in zip(got, STORED_PRED, STORED_CI):
        assert abs(r["prediction"] - p) < 1e-8
        assert abs(r["lower"] - lo) < 1e-8 and abs(r["upper"] - hi) < 1e-8
    assert got[0]["date"] == dt.date(2025, 12, 13)


def test_css_recursion_matches_python_loop(spark):
    rng = np.random.default_rng(5)
    y = np.cumsum(rng.normal(0, 1, 80)) + 100
    df = spark.createDataFrame(pd.DataFrame({"ticker": "t", "date": pd.date_range("2020-01-01", periods=80).date,
                                             "Close": y}))
    fit = FC.fit_arima(df).first()
    d = np.diff(y)

    def sse(phi, theta):
        e_prev, s = 0.0, 0.0
        for t in range(1, len(d)):
            e = d[t] - phi * d[t - 1] - theta * e_prev
            s += e * e
            e_prev = e
        return s
    assert abs(fit["sse"] - sse(fit["phi"], fit["theta"])) < 1e-9
    # the refined optimum is at least as good as every coarse grid point
    coarse = min(sse(i / 20, j / 20) for i in range(-19, 20) for j in range(-19, 20))
    assert fit["sse"] <= coarse + 1e-9
    n = len(d) - 1
    ll = -n / 2 * (math.log(2 * math.pi * fit["sse"] / n) + 1)
    assert abs(fit["aic"] - (-2 * ll + 6)) < 1e-6


def test_rules_invariants_and_hand_example(spark):
    rows = [("t", ["A", "B"]), ("t", ["A", "B"]), ("t", ["A"]), ("t", []), ("t", ["B", "C"])]
    b = spark.createDataFrame(rows, "ticker string, items array<string>")
    freq = RU.frequent_itemsets(b, 0.2)
    sup = {r["key"]: r["support"] for r in freq.collect()}
    assert sup == {"A": 0.6, "B": 0.6, "A,B": 0.4, "C": 0.2, "B,C": 0.2}
    rules = RU.all_rules(freq, 0.5).collect()
    for r in rules:
        s_c = sup[",".join(r["consequents"])]
        assert abs(r["lift"] * s_c - r["confidence"]) < 1e-12
    cmap = {(",".join(r["antecedents"]), ",".join(r["consequents"])): r for r in rules}
    assert abs(cmap[("A", "B")]["confidence"] - 2 / 3) < 1e-12
    assert cmap[("C", "B")]["conviction"] == float("inf")
    top = RU.top_rules(RU.all_rules(freq, 0.5), 10).collect()
    fulls = [tuple(sorted(r["antecedents"] + r["consequents"])) for r in top]
    assert len(fulls) == len(set(fulls))                     # one rule per combined itemset


def test_pca_against_numpy(spark, bars_small):
    cols = [c for c in FEATURE_COLUMNS if c != "date"]
    f = feature_matrix(bars_small)
    meta, _ = PC.fit_pca(f, cols, 5)
    m = {r["ticker"]: r for r in meta.collect()}
    pdf = PC.pca_inputs(f, cols).toPandas()
    for t, g in pdf.groupby("ticker"):
        x = g[cols].to_numpy(dtype=float)
        keep = [i for i in range(x.shape[1]) if x[:, i].min() != x[:, i].max()]
        z = (x[:, keep] - x[:, keep].mean(0)) / x[:, keep].std(0)
        s = np.linalg.svd(z, compute_uv=False) ** 2
        want = s[:5] / s.sum()
        got = np.array(m[t]["explained_variance_ratio"])
        assert np.allclose(got, want, atol=1e-9)
        comps = np.array(m[t]["components"])
        assert np.allclose(comps @ comps.T, np.eye(len(comps)), atol=1e-9)
        assert sum(got) <= 1 + 1e-12


def test_kmeans_invariants(spark):
    rng = np.random.default_rng(11)
    pts = np.concatenate([rng.normal(c, 0.3, (60, 2)) for c in ([0, 0], [5, 5], [0, 5])])
    pdf = pd.DataFrame({"ticker": ["a"] * 90 + ["b"] * 90, "date": list(range(180)), "x": pts[:, 0], "y": pts[:, 1]})
    labels, centers, summary = CL.kmeans(spark.createDataFrame(pdf), ["x", "y"], k=3, key=("date",))
    s = {r["ticker"]: r for r in summary.collect()}
    assert s["a"]["n_rows"] == sum(s["a"]["sizes"]) == 90
    lab = labels.toPandas()
    cen = {r["ticker"]: np.array(r["centers"]) for r in centers.collect()}
    for _, r in lab.merge(pdf, on=["ticker", "date"]).iterrows():
        d = ((cen[r["ticker"]] - np.array([r["x"], r["y"]])) ** 2).sum(1)
        assert r["cluster_label"] == int(np.argmin(d))
    inertia = lab.groupby("ticker")["d2"].sum()
    assert abs(inertia["a"] - s["a"]["inertia"]) < 1e-9


def test_arima_regrids_business_day_series(spark):
    days = pd.bdate_range("2024-01-01", periods=60)
    rng = np.random.default_rng(2)
    closes = np.cumsum(rng.normal(0, 1, len(days))) + 50
    keep = np.ones(len(days), bool)
    keep[[10, 11, 30]] = False                                 # gaps are forward filled on the B grid
    pdf = pd.DataFrame({"ticker": "b", "date": days.date, "Close": closes})
    full = FC.regrid(spark.createDataFrame(pdf), "Close").toPandas()
    assert (full["freq"] == "B").all() and len(full) == 60
    gappy = FC.regrid(spark.createDataFrame(pdf[keep]), "Close").toPandas()
    # a gappy weekday series is not regular B any more → daily grid incl. weekends
    assert (gappy["freq"] == "D").all()
    fc = FC.forecast(FC.fit_arima(spark.createDataFrame(pdf)), 5).orderBy("step").toPandas()
    from pandas.tseries.offsets import BDay
    assert list(fc["date"]) == [(days[-1] + BDay(i)).date() for i in range(1, 6)]


def test_split_stratified_and_contiguous_fallback(spark):
    from tickwise.operators.models import stratified_split
    rows = [("s", d, 1 if i % 3 else 0) for i, d in enumerate(pd.date_range("2024-01-01", periods=50).date)]
    rows += [("f", d, 1 if i else 0) for i, d in enumerate(pd.date_range("2024-01-01", periods=20).date)]
    out = stratified_split(spark.createDataFrame(rows, "ticker string, date date, label int")).toPandas()
    s = out[out.ticker == "s"]
    for lab, g in s.groupby("label"):
        assert g["is_val"].sum() == math.ceil(len(g) * 0.2)      # stratified per class
    f = out[out.ticker == "f"].sort_values("date")
    assert list(f["is_val"]) == [False] * 16 + [True] * 4          # one-member class → contiguous
