"""Checked queries for projections / filters (PRJ-*) and SRC-10/11."""
from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.functions.exprs import present
from tickwise.operators import projections as P
from tickwise.operators.timeseries import FEATURE_COLUMNS, densify_ffill
from tickwise.plans.catalog import register
from tickwise.plans.q_timeseries import EMA_DIGITS, features
from tickwise.plans.sqlparts import R, features_sql, rounded_select
from tickwise.sources.bars import bars_from_lineitem, bars_sql, sparse_series_from_orders
from tickwise.sources.quotes import market_history, quote_summary

FEAT = f"({features_sql()})"
SUPP_FEAT = f"({features_sql('l_suppkey')})"
BARS = f"({bars_sql()})"
NUMERIC = [c for c in FEATURE_COLUMNS if c not in ("date", "return")]
NUMERIC_D = [c for c in NUMERIC if c != "Volume"]
SPARSE = """(SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date,
                    avg(o_totalprice) AS Close FROM orders GROUP BY 1, 2)"""


@register("numeric_feature_columns", "PRJ-01",
          f"SELECT ticker, date, Volume, {rounded_select(NUMERIC_D, EMA_DIGITS)} FROM {FEAT}")
def q_numeric(spark, sf):
    f = features(spark, sf)
    return present(f.select("ticker", "date", *P.numeric_columns(f, ("date", "ticker", "return"))),
                   per_column=EMA_DIGITS)


@register("nonfinite_to_null", "PRJ-02", f"""
    SELECT ticker, count(*) AS n_rows,
           count(CASE WHEN isinf(ev) THEN NULL ELSE ev END) AS n_finite_exp,
           count(CASE WHEN isnan(nv) OR isinf(nv) THEN NULL ELSE nv END) AS n_finite_nan,
           {R("sum(CASE WHEN isinf(ev) THEN NULL ELSE ln(ev) END)", "sum_log_finite")}
    FROM (SELECT ticker, exp(Volume * 4.0) AS ev, exp(Volume * 4.0) * 0.0 AS nv FROM {BARS})
    GROUP BY ticker""")
def q_nonfinite(spark, sf):
    b = bars_from_lineitem(spark, sf).select(
        "ticker", F.exp(F.col("Volume") * 4.0).alias("ev"), (F.exp(F.col("Volume") * 4.0) * 0.0).alias("nv"))
    c = P.finite_only(b)
    return present(c.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("ev").alias("n_finite_exp"),
        F.count("nv").alias("n_finite_nan"), F.sum(F.ln("ev")).alias("sum_log_finite")))


@register("training_rows", "PRJ-04, TS-13", f"""
    SELECT ticker, date, {R('"return"', '"return"')}, {R("target_return", "target_return")}
    FROM (SELECT ticker, date, "return", lead("return") OVER (PARTITION BY ticker ORDER BY date) AS target_return
          FROM {FEAT}) WHERE target_return IS NOT NULL""")
def q_training_rows(spark, sf):
    from tickwise.operators.timeseries import next_targets
    f = next_targets(features(spark, sf))
    return present(P.complete_cases(f, NUMERIC + ["target_return"]).select("ticker", "date", "return", "target_return"))


def _unpivot_sql(src: str, cols: list[str]) -> str:
    items = ", ".join(f"struct_pack(feature := '{c}', v := CAST(\"{c}\" AS DOUBLE))" for c in cols)
    return f"(SELECT ticker, kv.feature AS feature, kv.v AS v FROM (SELECT ticker, unnest([{items}]) AS kv FROM {src}))"


@register("constant_columns", "PRJ-05", f"""
    SELECT ticker, feature,
           NOT coalesce(min(v) <> max(v) OR (count(v) > 0 AND count(v) < count(*)), false) AS is_constant
    FROM {_unpivot_sql(SUPP_FEAT, NUMERIC)} GROUP BY ticker, feature""")
def q_constant(spark, sf):
    return P.constant_columns(features(spark, sf, "l_suppkey"), NUMERIC)


@register("log_volume", "PRJ-06", f"SELECT ticker, date, {R('ln(1 + Volume)', 'log_volume')} FROM {BARS}")
def q_log_volume(spark, sf):
    return present(bars_from_lineitem(spark, sf).select("ticker", "date", P.log_volume(F.col("Volume")).alias("log_volume")))


@register("impute_sparse_grid", "PRJ-07, TS-16", f"""
    WITH s AS {SPARSE},
    span AS (SELECT ticker, min(date) AS d0, max(date) AS d1 FROM s GROUP BY ticker),
    grid AS (SELECT ticker, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
    g AS (SELECT grid.ticker, grid.date, s.Close FROM grid LEFT JOIN s USING (ticker, date))
    SELECT ticker, date, {R('''coalesce(
        last_value(Close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(Close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
        quantile_cont(Close, 0.5) OVER (PARTITION BY ticker), 0.0)''', 'Close')},
        Close IS NULL AS was_missing
    FROM g""")
def q_impute(spark, sf):
    s = sparse_series_from_orders(spark, sf)
    span = s.groupBy("ticker").agg(F.min("date").alias("d0"), F.max("date").alias("d1"))
    grid = span.select("ticker", F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAYS"))).alias("date"))
    g = grid.join(s, ["ticker", "date"], "left").withColumn("was_missing", F.col("Close").isNull())
    return present(P.impute(g, ["Close"]))


@register("calendar_ffill", "TS-16", f"""
    WITH s AS {SPARSE},
    span AS (SELECT ticker, min(date) AS d0, max(date) AS d1 FROM s GROUP BY ticker),
    grid AS (SELECT ticker, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS date FROM span)
    SELECT ticker, date, {R('''last_value(s.Close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''', 'Close')}
    FROM grid LEFT JOIN s USING (ticker, date)""")
def q_calendar_ffill(spark, sf):
    return present(densify_ffill(sparse_series_from_orders(spark, sf), ["Close"]))


@register("date_window", "PRJ-08",
          f"SELECT ticker, date, {R('Close', 'Close')} FROM {BARS} WHERE date >= DATE '1996-03-01'")
def q_date_window(spark, sf):
    # the upper bound is unparsable and therefore ignored
    return present(P.date_range(bars_from_lineitem(spark, sf), "1996-03-01", "not a date")
                   .select("ticker", "date", "Close"))


@register("parse_dates", "PRJ-09", """
    SELECT o_orderkey, CAST(TRY_CAST(txt AS TIMESTAMP) AS DATE) AS date
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
                                  ELSE CAST(o_orderdate AS VARCHAR) END AS txt FROM orders)
    WHERE TRY_CAST(txt AS TIMESTAMP) IS NOT NULL""")
def q_parse_dates(spark, sf):
    from tickwise.sources.tables import read_table
    o = read_table(spark, sf, "orders").select(
        "o_orderkey",
        # pending orders carry their priority text instead of a date (unparsable)
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .otherwise(F.col("o_orderdate").cast("string")).alias("txt"))
    return P.parse_dates(o, "txt").select("o_orderkey", "date")


@register("aligned_features", "PRJ-10, PRJ-11", f"""
    SELECT ticker, date, {R('Close', 'Close')}, {R('sma_5', 'sma_5')}, {R('rsi_14', 'rsi_14')},
           CAST(NULL AS DOUBLE) AS beta FROM {FEAT}""")
def q_aligned(spark, sf):
    f = features(spark, sf)
    a = P.align_to_features(f, ["ticker", "date", "Close", "sma_5", "rsi_14"])
    return present(P.with_missing_as_null(a, ["Close", "sma_5", "rsi_14", "beta"], keep=["ticker", "date"]))


@register("latest_feature_row", "PRJ-12", f"""
    SELECT ticker, date, Volume, {rounded_select(NUMERIC_D + ['return'], EMA_DIGITS)}
    FROM {SUPP_FEAT} QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1""")
def q_latest(spark, sf):
    return present(P.latest_row(features(spark, sf, "l_suppkey")), per_column=EMA_DIGITS)


@register("last_30_rows", "PRJ-13, TK-08", f"""
    SELECT ticker, date, {R('Close', 'Close')} FROM {SUPP_FEAT}
    QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 30""")
def q_last_rows(spark, sf):
    return present(P.last_n_rows(features(spark, sf, "l_suppkey"), 30).select("ticker", "date", "Close"))


@register("market_history_6mo", "SRC-10, PRJ-14", f"""
    WITH b AS {BARS}, m AS (SELECT ticker, max(date) AS mx FROM b GROUP BY ticker)
    SELECT b.ticker, strftime(b.date, '%Y-%m-%d') AS date, {R('Open', 'Open', 3)}, {R('High', 'High', 3)},
           {R('Low', 'Low', 3)}, {R('Close', 'Close', 3)}, Volume
    FROM b JOIN m USING (ticker) WHERE b.date > CAST(m.mx - INTERVAL 6 MONTH AS DATE)""")
def q_market_history(spark, sf):
    return market_history(bars_from_lineitem(spark, sf), "6mo")


@register("quote_summary", "SRC-11", f"""
    WITH b AS {BARS},
    r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rk,
                 max(date) OVER (PARTITION BY ticker) AS mx FROM b)
    SELECT ticker,
           {R("max(CASE WHEN rk = 1 THEN Close END)", "last_price", 3)},
           {R("max(CASE WHEN rk = 2 THEN Close END)", "previous_close", 3)},
           {R("max(CASE WHEN date > CAST(mx - INTERVAL 1 YEAR AS DATE) THEN High END)", "high_52w", 3)},
           {R("min(CASE WHEN date > CAST(mx - INTERVAL 1 YEAR AS DATE) THEN Low END)", "low_52w", 3)}
    FROM r GROUP BY ticker""")
def q_quote(spark, sf):
    return quote_summary(bars_from_lineitem(spark, sf))


@register("vector_parse", "PRJ-15", f"""
    SELECT ticker, date, CAST(len(v) AS BIGINT) AS n_items, v[1] AS v0, v[2] AS v1, v[3] AS v2, v[4] AS v3
    FROM (SELECT ticker, date, list_transform(list_filter(string_split(txt, ','), lambda x: trim(x) <> ''),
                                                lambda x: TRY_CAST(trim(x) AS DOUBLE)) AS v
          FROM (SELECT ticker, date, CAST(Volume AS VARCHAR) || ', ,' || CAST(dayofmonth(date) AS VARCHAR)
                       || ',x,' || CAST(month(date) AS VARCHAR) || ',' AS txt FROM {BARS}))""")
def q_vector_parse(spark, sf):
    b = bars_from_lineitem(spark, sf)
    txt = F.concat(F.col("Volume").cast("string"), F.lit(", ,"), F.dayofmonth("date").cast("string"),
                   F.lit(",x,"), F.month("date").cast("string"), F.lit(","))
    v = b.select("ticker", "date", P.parse_vector(txt).alias("v"))
    return v.select("ticker", "date", F.size("v").cast("bigint").alias("n_items"),
                    F.col("v")[0].alias("v0"), F.col("v")[1].alias("v1"),
                    F.col("v")[2].alias("v2"), F.col("v")[3].alias("v3"))
