"""Time-series window operators TS-01 … TS-20, all keyed by ticker.

Every ordered operator uses ``Window.partitionBy(ticker).orderBy(date)``; the
rolling features of one stage share one window spec so Spark plans a single
exchange + sort for them.  Frames shorter than the window yield NULL
(``count == w`` guards), matching pandas ``rolling(w)``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickwise.operators.ema import add_row_number, ema  # noqa: F401  (re-exported)

FEATURE_COLUMNS = [
    "date", "Open", "High", "Low", "Close", "Adj_Close", "Volume",
    "return", "log_return", "sma_5", "ema_5", "sma_10", "ema_10", "sma_20", "ema_20",
    "vol_10", "rsi_14", "macd", "macd_signal", "macd_hist",
    "lag_close_1", "lag_return_1", "lag_close_2", "lag_return_2",
    "lag_close_3", "lag_return_3", "lag_close_5", "lag_return_5",
]
EMA_COLUMNS = ["ema_5", "ema_10", "ema_20", "macd", "macd_signal", "macd_hist"]
LAGS = [1, 2, 3, 5]


def by_date(part: str = "ticker", order: str = "date") -> Window:
    return Window.partitionBy(part).orderBy(order)


def rolling(w: Window, n: int) -> Window:
    return w.rowsBetween(-(n - 1), 0)


def full_window(agg, c: Column, w: Window, n: int, min_periods: int | None = None) -> Column:
    """``agg(c)`` over the last ``n`` rows, NULL until ``min_periods`` (default
    ``n``) non-null values are in the frame (TS-03/04/06)."""
    f = rolling(w, n)
    return F.when(F.count(c).over(f) >= (min_periods or n), agg(c).over(f))


def simple_return(c: Column, w: Window) -> Column:
    """TS-01: ``c_t / c_(t-1) - 1``."""
    return F.try_divide(c, F.lag(c, 1).over(w)) - F.lit(1.0)


def log_return(c: Column, w: Window) -> Column:
    """TS-02: ``ln c_t - ln c_(t-1)`` (ln of a non-positive value is NULL)."""
    return F.ln(c) - F.lag(F.ln(c), 1).over(w)


def gain_loss(delta: Column) -> tuple[Column, Column]:
    """TS-08: clip at zero, NULL stays NULL (bare ``greatest`` would give 0)."""
    gain = F.when(delta.isNotNull(), F.greatest(delta, F.lit(0.0)))
    loss = F.when(delta.isNotNull(), -F.least(delta, F.lit(0.0)))
    return gain, loss


def rsi(gain: Column, loss: Column, w: Window, n: int = 14) -> Column:
    """TS-09: simple n-row means (not Wilder), ``rs = g/(l+1e-9)``."""
    g = full_window(F.avg, gain, w, n)
    lo = full_window(F.avg, loss, w, n)
    return F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + g / (lo + F.lit(1e-9)))


def feature_matrix(bars: DataFrame, drop_incomplete: bool = True,
                   part: str = "ticker") -> DataFrame:
    """TS-15: TS-01 … TS-12 in two window stages + the EMA scan, then PRJ-03.

    Stage 1 (one sort): row number, return, log return, diff, SMAs, close lags.
    Stage 2 (same ordering, no new sort): volatility, RSI, return lags.
    EMA stage: blocked scan over the same ``ticker`` partitioning.
    """
    w = by_date(part)
    c = F.col("Close")
    s1 = bars.select(
        "*",
        (F.row_number().over(w) - 1).cast("long").alias("_rn"),
        simple_return(c, w).alias("return"),
        log_return(c, w).alias("log_return"),
        (c - F.lag(c, 1).over(w)).alias("_delta"),
        *[full_window(F.avg, c, w, n).alias(f"sma_{n}") for n in (5, 10, 20)],
        *[F.lag(c, k).over(w).alias(f"lag_close_{k}") for k in LAGS],
    )
    gain, loss = gain_loss(F.col("_delta"))
    r = F.col("return")
    s2 = s1.select(
        "*",
        full_window(F.stddev_samp, r, w, 10).alias("vol_10"),
        rsi(gain, loss, w, 14).alias("rsi_14"),
        *[F.lag(r, k).over(w).alias(f"lag_return_{k}") for k in LAGS],
    )
    s3 = ema(s2, {"ema_5": ("Close", 5), "ema_10": ("Close", 10), "ema_20": ("Close", 20),
                  "_ema_12": ("Close", 12), "_ema_26": ("Close", 26)}, part=part,
             keep_blocks=True)
    s3 = s3.withColumn("macd", F.col("_ema_12") - F.col("_ema_26"))
    s4 = ema(s3, {"macd_signal": ("macd", 9)}, part=part)
    out = s4.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    out = out.select(part, *FEATURE_COLUMNS)
    if drop_incomplete:
        out = out.na.drop()
    return out


def sma_min_periods(df: DataFrame, col: str = "Close", n: int = 10, min_periods: int = 5,
                    part: str = "ticker", out: str | None = None) -> DataFrame:
    """TS-04: ``rolling(n, min_periods)`` mean."""
    return df.withColumn(out or f"sma_{n}_mp{min_periods}",
                         full_window(F.avg, F.col(col), by_date(part), n, min_periods))


def next_targets(df: DataFrame, part: str = "ticker") -> DataFrame:
    """TS-13 / TS-14: next-row return (regression target), next close and
    next close return ``(c_(t+1) - c_t) / c_t``."""
    w = by_date(part)
    c = F.col("Close")
    return df.select("*",
                     F.lead("return", 1).over(w).alias("target_return"),
                     F.lead(c, 1).over(w).alias("next_close"),
                     F.try_divide(F.lead(c, 1).over(w) - c, c).alias("next_return"))


def densify_ffill(series: DataFrame, value_cols: list[str], part: str = "ticker",
                  step_days: int = 1) -> DataFrame:
    """TS-16: calendar grid from each ticker's first to last date, values
    forward filled (``asfreq(freq).ffill()``).

    The grid is generated per ticker by ``sequence`` (one small row per ticker
    exploded on the executors), joined back on (ticker, date).
    """
    span = series.groupBy(part).agg(F.min("date").alias("_d0"), F.max("date").alias("_d1"))
    grid = span.select(part, F.explode(F.sequence("_d0", "_d1",
                                                  F.expr(f"INTERVAL {step_days} DAYS"))).alias("date"))
    j = grid.join(series, [part, "date"], "left")
    w = by_date(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return j.select(part, "date", *[F.last(F.col(v), ignorenulls=True).over(w).alias(v)
                                   for v in value_cols])


def infer_frequency(series: DataFrame, part: str = "ticker") -> DataFrame:
    """TS-17: D / B / W from the gaps between consecutive dates (fewer than
    3 dates → D).  One window (lag) + one aggregate; month or quarter codes
    are not inferred (documented limit)."""
    w = by_date(part)
    g = series.select(part, "date",
                      F.datediff("date", F.lag("date", 1).over(w)).alias("gap"),
                      F.dayofweek("date").alias("dow"))
    gap, dow = F.col("gap"), F.col("dow")

    def never(cond):
        return F.coalesce(F.max(F.when(cond, 1).otherwise(0)), F.lit(0)) == 0

    agg = g.groupBy(part).agg(
        F.count(F.lit(1)).alias("n_dates"),
        never(gap != 1).alias("all1"),
        never(dow.isin(1, 7)).alias("no_weekend"),
        never(~gap.isin(1, 3)).alias("only13"),
        never((gap == 3) & (dow != 2)).alias("ok3"),
        never((gap == 1) & (dow == 2)).alias("ok1"),
        never(gap != 7).alias("all7"),
    )
    c = F.col
    freq = (F.when(c("n_dates") < 3, "D")
            .when(c("all1"), "D")
            .when(c("no_weekend") & c("only13") & c("ok3") & c("ok1"), "B")
            .when(c("all7"), "W")
            .otherwise("D"))
    return agg.select(part, c("n_dates").cast("bigint").alias("n_dates"), freq.alias("freq"))


def roll_to_friday(d: Column) -> Column:
    """Weekend date → the Friday before (pandas ``BDay`` rolls back first)."""
    dow = F.dayofweek(d)  # 1 = Sunday … 7 = Saturday
    return F.when(dow == 7, F.date_sub(d, 1)).when(dow == 1, F.date_sub(d, 2)).otherwise(d)


def add_business_days(d: Column, n: Column) -> Column:
    """TS-18: ``d + BDay(n)`` for n ≥ 1 with weekend ``d`` rolled to Friday."""
    f = roll_to_friday(d)
    wd = (F.dayofweek(f) + 5) % 7  # Monday = 0 … Friday = 4
    return F.date_add(f, (n + F.lit(2) * F.floor((wd + n) / 5)).cast("int"))


def forecast_dates(last_date: Column, horizon: int, freq: Column) -> Column:
    """TS-19: ``horizon`` future dates after ``last_date`` for D, B or W."""
    steps = F.sequence(F.lit(1), F.lit(horizon))
    return (F.when(freq == "B", F.transform(steps, lambda s: add_business_days(last_date, s)))
            .when(freq == "W", F.transform(steps, lambda s: F.date_add(last_date, s * 7)))
            .otherwise(F.transform(steps, lambda s: F.date_add(last_date, s))))


def chronological_split(df: DataFrame, frac: float = 0.8, part: str = "ticker",
                        flag: str = "is_train") -> DataFrame:
    """TS-20: first ``int(frac·n)`` rows of each ticker are training rows."""
    w = by_date(part)
    n = F.count(F.lit(1)).over(Window.partitionBy(part))
    return df.withColumn(flag, F.row_number().over(w) <= F.floor(n * F.lit(frac)))


__all__ = ["feature_matrix", "add_row_number", "ema", "by_date"]
