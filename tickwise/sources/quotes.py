"""SRC-10 / SRC-11: look-back history and quote summary computed from bars."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickwise.functions.exprs import rounded

# Fixed look-back codes and their calendar offsets (months / days); unknown → 1mo.
PERIODS = {"1w": ("days", 7), "1mo": ("months", 1), "3mo": ("months", 3), "6mo": ("months", 6),
           "1y": ("months", 12), "2y": ("months", 24), "5y": ("months", 60), "max": (None, None)}


def _cutoff(mx, period: str):
    unit, n = PERIODS.get(period, PERIODS["1mo"])
    if unit is None:
        return None
    return F.date_sub(mx, n) if unit == "days" else F.add_months(mx, -n)


def market_history(bars: DataFrame, period: str = "1mo", part: str = "ticker") -> DataFrame:
    """Rows newer than (latest date − period) per ticker, OHLC rounded to 3
    decimals, date as text.  The per-ticker max is a window over the ticker
    partition (no join)."""
    mx = F.max("date").over(Window.partitionBy(part))
    b = bars.withColumn("_mx", mx)
    cut = _cutoff(F.col("_mx"), period)
    if cut is not None:
        b = b.where(F.col("date") > cut)
    return b.select(part, F.date_format("date", "yyyy-MM-dd").alias("date"),
                    *[rounded(F.col(c), 3).alias(c) for c in ("Open", "High", "Low", "Close")],
                    F.col("Volume").cast("bigint").alias("Volume"))


def quote_summary(bars: DataFrame, part: str = "ticker") -> DataFrame:
    """Last price, previous close and 52-week high / low per ticker, rounded
    to 3 decimals; non-finite → NULL."""
    w = Window.partitionBy(part).orderBy(F.col("date").desc())
    b = bars.select(part, "date", "Close", "High", "Low",
                    F.row_number().over(w).alias("rk"),
                    F.max("date").over(Window.partitionBy(part)).alias("mx"))
    in_year = F.col("date") > F.add_months(F.col("mx"), -12)
    agg = b.groupBy(part).agg(
        F.max(F.when(F.col("rk") == 1, F.col("Close"))).alias("last_price"),
        F.max(F.when(F.col("rk") == 2, F.col("Close"))).alias("previous_close"),
        F.max(F.when(in_year, F.col("High"))).alias("high_52w"),
        F.min(F.when(in_year, F.col("Low"))).alias("low_52w"))
    from tickwise.functions.exprs import finite
    return agg.select(part, *[rounded(finite(F.col(c)), 3).alias(c)
                              for c in ("last_price", "previous_close", "high_52w", "low_52w")])
