"""SRC-03: daily OHLCV bars from any tick-like table.

open = first price of the day, close = last, high/low = extremes, volume =
sum of quantities.  "First" and "last" follow a *total* order key (a struct
of columns that is unique per tick), so the result does not depend on file
order or partitioning.  ``min_by`` / ``max_by`` / ``min`` / ``max`` / ``sum``
are all partial aggregates: each map task combines its rows per
(ticker, date) before the shuffle, so a hot ticker or a hot day only sends
one partial row per map task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickwise.sources.tables import read_table

#: Ticks whose bars one task holds, at most a bar each.
PART_TICKS = 250_000

BAR_COLUMNS = ["ticker", "date", "Open", "High", "Low", "Close", "Adj_Close", "Volume"]

# Columns that together identify one lineitem row (fixed by the data set:
# (l_orderkey, l_linenumber) alone is not unique in the generated tables).
LINEITEM_ORDER_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      "l_extendedprice", "l_quantity"]


def build_bars(ticks: DataFrame, ticker: Column, ts: Column, price: Column,
               qty: Column, order_key: list[Column]) -> DataFrame:
    key = F.struct(*order_key)
    t = ticks.select(ticker.alias("ticker"), F.to_date(ts).alias("date"),
                     price.alias("price"), qty.alias("qty"), key.alias("okey"))
    t = t.where(F.col("price").isNotNull() & F.col("date").isNotNull() & F.col("ticker").isNotNull())
    return (t.groupBy("ticker", "date")
            .agg(F.min_by("price", "okey").alias("Open"),
                 F.max("price").alias("High"),
                 F.min("price").alias("Low"),
                 F.max_by("price", "okey").alias("Close"),
                 F.sum("qty").alias("vol"))
            .select("ticker", "date", "Open", "High", "Low", "Close",
                    F.col("Close").alias("Adj_Close"),
                    F.col("vol").cast("bigint").alias("Volume")))


def bars_from_lineitem(spark: SparkSession, sf_dir: str, key: str = "l_returnflag") -> DataFrame:
    """Bars keyed by ``key`` (3 tickers for ``l_returnflag``, one per supplier
    for ``l_suppkey``); price = extended price per unit."""
    li = read_table(spark, sf_dir, "lineitem")
    return build_bars(
        li,
        ticker=F.col(key).cast("string"),
        ts=F.col("l_shipdate"),
        price=F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")),
        qty=F.col("l_quantity"),
        order_key=[F.col(c) for c in LINEITEM_ORDER_KEY],
    )


def dealt(bars: DataFrame, ticks: DataFrame, key: str, part_ticks: int = PART_TICKS) -> DataFrame:
    """``bars`` of many tickers, dealt by ticker into as many parts as their ticks ask for.

    Bars shuffle as few bytes and grow into wide feature rows: parts that are
    sized by the shuffled bytes hold too many of them.  A table that the
    session's cores hold anyway, and one of fewer tickers than parts, stay as
    they are.  ``ticks`` are counted from the files' footers.
    """
    cores = ticks.sparkSession.sparkContext.defaultParallelism
    parts = -(-ticks.count() // part_ticks)
    if parts <= cores or ticks.agg(F.approx_count_distinct(key)).first()[0] < parts:
        return bars
    return bars.repartition(parts, "ticker")


def sparse_series_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gappy daily close series: average order price per priority and day."""
    o = read_table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("ticker"),
                      F.to_date("o_orderdate").alias("date"))
            .agg(F.avg("o_totalprice").alias("Close")))


def bars_sql(key: str = "l_returnflag") -> str:
    """DuckDB twin of ``bars_from_lineitem`` (used inside oracles)."""
    okey = ", ".join(LINEITEM_ORDER_KEY)
    return f"""
    SELECT CAST({key} AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date,
           first(l_extendedprice / l_quantity ORDER BY {okey}) AS Open,
           max(l_extendedprice / l_quantity) AS High,
           min(l_extendedprice / l_quantity) AS Low,
           last(l_extendedprice / l_quantity ORDER BY {okey}) AS Close,
           last(l_extendedprice / l_quantity ORDER BY {okey}) AS Adj_Close,
           CAST(sum(l_quantity) AS BIGINT) AS Volume
    FROM lineitem
    WHERE l_quantity <> 0 AND l_shipdate IS NOT NULL AND {key} IS NOT NULL
    GROUP BY 1, 2"""
