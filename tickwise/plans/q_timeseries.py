"""Checked queries for the time-series operators (TS-*)."""
from __future__ import annotations

from tickwise.functions.exprs import present
from tickwise.operators.timeseries import FEATURE_COLUMNS, feature_matrix
from tickwise.plans.catalog import register
from tickwise.plans.sqlparts import features_sql, rounded_select
from tickwise.sources.bars import bars_from_lineitem, dealt
from tickwise.sources.tables import read_table

FEAT_DOUBLES = [c for c in FEATURE_COLUMNS if c not in ("date", "Volume")]
# EMA-derived columns come from two different (exact) algorithms in the two
# engines; they agree to ~1e-11, so they are compared at 1e-4.
EMA_DIGITS = {"ema_5": 4, "ema_10": 4, "ema_20": 4, "macd": 4, "macd_signal": 4, "macd_hist": 4}


def features(spark, sf_dir, key="l_returnflag"):
    return feature_matrix(dealt(bars_from_lineitem(spark, sf_dir, key), read_table(spark, sf_dir, "lineitem"), key))


@register("feature_matrix", "TS-01..TS-12, TS-15, PRJ-03",
          f"SELECT ticker, date, Volume, {rounded_select(FEAT_DOUBLES, EMA_DIGITS)} "
          f"FROM ({features_sql()})")
def q_feature_matrix(spark, sf_dir):
    return present(features(spark, sf_dir), per_column=EMA_DIGITS)


# ---------------------------------------------------------------- more TS ops
from pyspark.sql import functions as F  # noqa: E402

from tickwise.operators import timeseries as TS  # noqa: E402
from tickwise.plans.sqlparts import R, features_sql as _fsql  # noqa: E402
from tickwise.sources.bars import bars_sql  # noqa: E402

_BARS = f"({bars_sql()})"
_SUPP_FEAT = f"({_fsql('l_suppkey')})"


@register("sma10_min5", "TS-04", f"""
    SELECT ticker, date, {R('''CASE WHEN count(Close) OVER w >= 5 THEN avg(Close) OVER w END''', 'sma_10_mp5')}
    FROM {_BARS} WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""")
def q_sma_mp(spark, sf):
    b = bars_from_lineitem(spark, sf)
    return present(TS.sma_min_periods(b, "Close", 10, 5).select("ticker", "date", "sma_10_mp5"))


@register("next_day_targets", "TS-13, TS-14", f"""
    SELECT ticker, date, {R("lead(Close) OVER w", "next_close")},
           {R("(lead(Close) OVER w - Close) / Close", "next_return")},
           {R('lead(ret) OVER w', 'target_return')}
    FROM (SELECT *, Close / lag(Close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret FROM {_BARS})
    WINDOW w AS (PARTITION BY ticker ORDER BY date)""")
def q_next_targets(spark, sf):
    b = bars_from_lineitem(spark, sf)
    b = b.withColumn("return", TS.simple_return(F.col("Close"), TS.by_date()))
    return present(TS.next_targets(b).select("ticker", "date", "next_close", "next_return", "target_return"))


def _freq_series_spark(spark, sf):
    b = bars_from_lineitem(spark, sf).select("ticker", "date")
    wk = b.where(~F.dayofweek("date").isin(1, 7)).select(F.concat("ticker", F.lit(":weekdays")).alias("ticker"), "date")
    mon = b.where(F.dayofweek("date") == 2).select(F.concat("ticker", F.lit(":mondays")).alias("ticker"), "date")
    return b.unionByName(wk).unionByName(mon)


_FREQ_SERIES = f"""(SELECT ticker, date FROM {_BARS}
    UNION ALL SELECT ticker || ':weekdays', date FROM {_BARS} WHERE dayofweek(date) NOT IN (0, 6)
    UNION ALL SELECT ticker || ':mondays', date FROM {_BARS} WHERE dayofweek(date) = 1)"""

_FREQ_SQL = f"""
    SELECT ticker, CAST(count(*) AS BIGINT) AS n_dates,
      CASE WHEN count(*) < 3 THEN 'D'
           WHEN coalesce(max(CASE WHEN gap <> 1 THEN 1 ELSE 0 END), 0) = 0 THEN 'D'
           WHEN coalesce(max(CASE WHEN dow IN (0, 6) THEN 1 ELSE 0 END), 0) = 0
            AND coalesce(max(CASE WHEN gap NOT IN (1, 3) THEN 1 ELSE 0 END), 0) = 0
            AND coalesce(max(CASE WHEN gap = 3 AND dow <> 1 THEN 1 ELSE 0 END), 0) = 0
            AND coalesce(max(CASE WHEN gap = 1 AND dow = 1 THEN 1 ELSE 0 END), 0) = 0 THEN 'B'
           WHEN coalesce(max(CASE WHEN gap <> 7 THEN 1 ELSE 0 END), 0) = 0 THEN 'W'
           ELSE 'D' END AS freq
    FROM (SELECT ticker, date, dayofweek(date) AS dow,
                 date - lag(date) OVER (PARTITION BY ticker ORDER BY date) AS gap FROM {_FREQ_SERIES})
    GROUP BY ticker"""


@register("series_frequency", "TS-17", _FREQ_SQL)
def q_freq(spark, sf):
    return TS.infer_frequency(_freq_series_spark(spark, sf))


_BDAY_SQL_EXPR = """(f + CAST(n + 2 * floor(((dayofweek(f) + 6) % 7 + n) / 5) AS INTEGER))"""


@register("business_day_add", "TS-18", f"""
    SELECT ticker, date, n, {_BDAY_SQL_EXPR} AS bday
    FROM (SELECT ticker, date, CAST(1 + dayofmonth(date) % 10 AS INTEGER) AS n,
                 CASE dayofweek(date) WHEN 6 THEN date - 1 WHEN 0 THEN date - 2 ELSE date END AS f
          FROM {_BARS})""")
def q_bday(spark, sf):
    b = bars_from_lineitem(spark, sf).select("ticker", "date",
                                              (F.lit(1) + F.dayofmonth("date") % 10).alias("n"))
    return b.select("ticker", "date", F.col("n").cast("int").alias("n"),
                    TS.add_business_days(F.col("date"), F.col("n")).alias("bday"))


@register("forecast_calendar", "TS-19", f"""
    WITH fq AS ({_FREQ_SQL}),
    last AS (SELECT ticker, max(date) AS d FROM {_FREQ_SERIES} GROUP BY ticker),
    steps AS (SELECT ticker, freq, d, unnest(range(1, 8)) AS step FROM fq JOIN last USING (ticker)),
    base AS (SELECT *, CASE dayofweek(d) WHEN 6 THEN d - 1 WHEN 0 THEN d - 2 ELSE d END AS f, step AS n FROM steps)
    SELECT ticker, CAST(step AS BIGINT) AS step,
           CASE WHEN freq = 'B' THEN {_BDAY_SQL_EXPR}
                WHEN freq = 'W' THEN d + CAST(7 * step AS INTEGER)
                ELSE d + CAST(step AS INTEGER) END AS date
    FROM base""")
def q_forecast_calendar(spark, sf):
    s = _freq_series_spark(spark, sf)
    fq = TS.infer_frequency(s)
    last = s.groupBy("ticker").agg(F.max("date").alias("d"))
    j = fq.join(last, "ticker")
    out = j.select("ticker", F.posexplode(TS.forecast_dates(F.col("d"), 7, F.col("freq"))).alias("i", "date"))
    return out.select("ticker", (F.col("i") + 1).cast("bigint").alias("step"), "date")


@register("chronological_split", "TS-20", f"""
    SELECT ticker, date, row_number() OVER (PARTITION BY ticker ORDER BY date)
                         <= floor(0.8 * count(*) OVER (PARTITION BY ticker)) AS is_train
    FROM {_SUPP_FEAT}""")
def q_chrono(spark, sf):
    return TS.chronological_split(features(spark, sf, "l_suppkey")).select("ticker", "date", "is_train")
