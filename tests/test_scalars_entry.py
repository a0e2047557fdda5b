"""Scalar functions against worked values; driver contract and plan-shape tests."""
from pyspark.sql import functions as F

from tickwise.functions import scalars as S


DURATIONS = {
    0: "0s", 59: "59s", 60: "1m 0s", 3599: "59m 59s", 3600: "1h 0s", 86399: "23h 59m 59s", 86400: "1d 0s",
    90061.7: "1d 1h 1m 1s", 1e6: "11d 13h 46m 40s",
}
SIZES = {
    0: "0.0 B", 1: "1.0 B", 1023: "1023.0 B", 1024: "1.0 KB", 1280: "1.2 KB", 1792: "1.8 KB", 1536: "1.5 KB", 1000000: "976.6 KB",
    5368709120: "5.0 GB", 3573412790272: "3.2 TB", 7881299347898368: "7.0PB",
}
TOKENS = {"lag_close_1": "LC1", "rsi 14-day": "R1D", "___": "___", "": "", "macd_signal_hist_extra_more_words": "MSHEMW", "Volume": "V"}


def test_scalars_by_worked_values(spark):
    for kind, pairs, fn in (("double", DURATIONS, S.humanize_seconds), ("long", SIZES, S.human_size), ("string", TOKENS, S.short_token)):
        rows = [(float(k) if kind == "double" else k,) for k in pairs]
        got = spark.createDataFrame(rows, f"x {kind}").select(fn(F.col("x")).alias("y")).collect()
        assert [r["y"] for r in got] == list(pairs.values())


def test_safe_ticker_and_windows(spark):
    df = spark.createDataFrame([(None,), ("",), ("msft",)], "t string")
    assert [r[0] for r in df.select(S.safe_ticker(F.col("t"))).collect()] == ["AAPL", "AAPL", "MSFT"]
    names = ["lag_close_5", "lag_return_3", "sma_20", "ema_26", "rsi_14", "macd"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(S.feature_window(F.col("n"))).collect()] == [5, 3, 20, 26, 1, 1]


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "macd_signal" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_is_jvm_only_and_distributed(spark):
    from tickwise.operators.timeseries import feature_matrix
    from tickwise.sources.bars import bars_from_lineitem
    spark.catalog.clearCache()          # a cached fixture would be substituted into the plan
    p = _plan(feature_matrix(bars_from_lineitem(spark, "/root/testdata/sf0.001")))
    assert "SinglePartition" not in p
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    # partial bars → (ticker, date); bars → ticker; nothing else
    assert p.count("Exchange hashpartitioning") == 2


def test_scan_prunes_columns_and_pushes_filters(spark):
    from tickwise.operators.projections import date_range
    from tickwise.sources.bars import bars_from_lineitem
    df = date_range(bars_from_lineitem(spark, "/root/testdata/sf0.001"), "1996-01-01", "1996-06-30")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(l_shipdate)" in p or "l_shipdate" in p
    assert "l_discount" not in p and "l_tax" not in p


def test_no_python_in_metric_and_check_plans(spark):
    import __spark_entry__ as E
    q = E.queries()
    for name in ["roc_auc", "ks_drift_columns", "calibration_report", "association_rules"]:
        p = _plan(q[name](spark, "/root/testdata/sf0.001"))
        assert "EvalPython" not in p and "SinglePartition" not in p, name
