"""Checked queries for sources (SRC-*)."""
from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.functions.exprs import present
from tickwise.plans.catalog import register
from tickwise.plans.sqlparts import rounded_select
from tickwise.sources.bars import bars_from_lineitem, bars_sql

BAR_NUM = ["Open", "High", "Low", "Close", "Adj_Close"]


@register("bars_daily", "SRC-03",
          f"SELECT ticker, date, {rounded_select(BAR_NUM)}, Volume FROM ({bars_sql('l_returnflag')})")
def bars_daily(spark, sf_dir):
    return present(bars_from_lineitem(spark, sf_dir, "l_returnflag"))


@register("bars_by_supplier", "SRC-03",
          f"SELECT ticker, date, {rounded_select(BAR_NUM)}, Volume FROM ({bars_sql('l_suppkey')})")
def bars_by_supplier(spark, sf_dir):
    return present(bars_from_lineitem(spark, sf_dir, "l_suppkey"))


from tickwise.plans.q_timeseries import features  # noqa: E402
from tickwise.plans.sqlparts import R, features_sql  # noqa: E402
from tickwise.sources.tables import read_table, resolve_ticker_rows, ticker_from_path  # noqa: E402


def _resolve_sql(t: str) -> str:
    return f"""
    WITH f AS ({features_sql()}),
    k AS (SELECT coalesce((SELECT max(ticker) FROM f WHERE ticker = '{t}'), (SELECT max(ticker) FROM f)) AS t)
    SELECT ticker, date, {R('Close', 'Close')} FROM f, k WHERE f.ticker = k.t"""


@register("resolve_feature_set_exact", "SRC-09", _resolve_sql("N"))
def q_resolve_exact(spark, sf):
    return present(resolve_ticker_rows(features(spark, sf), "N").select("ticker", "date", "Close"))


@register("resolve_feature_set_fallback", "SRC-09", _resolve_sql("ZZZ"))
def q_resolve_fallback(spark, sf):
    return present(resolve_ticker_rows(features(spark, sf), "ZZZ").select("ticker", "date", "Close"))


@register("ticker_from_file_name", "SRC-01, SRC-04, SRC-06", "SELECT 'LINEITEM' AS ticker, count(*) AS n_rows FROM lineitem")
def q_ticker_from_file(spark, sf):
    li = read_table(spark, sf, "lineitem").where(F.col("_metadata.file_size") > 0)
    return li.groupBy(ticker_from_path().alias("ticker")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("normalised_vendor_columns", "SRC-05",
          f"SELECT ticker, date, {rounded_select(BAR_NUM)}, Volume FROM ({bars_sql('l_returnflag')})")
def q_normalise(spark, sf):
    from tickwise.sources.tables import normalise_columns
    vendor = bars_from_lineitem(spark, sf).withColumnsRenamed({"date": "Date", "Adj_Close": "Adj Close"})
    return present(normalise_columns(vendor).select("ticker", "date", *BAR_NUM, "Volume"))


@register("bars_sorted", "TK-01",
          f"SELECT ticker, date, {rounded_select(['Close'])} FROM ({bars_sql('l_returnflag')}) ORDER BY ticker, date")
def q_sorted(spark, sf):
    return present(bars_from_lineitem(spark, sf).select("ticker", "date", "Close").orderBy("ticker", "date"))
