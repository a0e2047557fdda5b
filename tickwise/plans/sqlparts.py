"""Reusable DuckDB SQL fragments for the oracles (twins of Spark operators)."""
from __future__ import annotations

from tickwise.functions.exprs import sql_round
from tickwise.sources.bars import bars_sql

R = sql_round


def features_sql(key: str = "l_returnflag", keep_incomplete: bool = False) -> str:
    """Twin of ``feature_matrix``: windows + a recursive CTE for the EMAs."""
    spans = {"ema_5": 5, "ema_10": 10, "ema_20": 20, "e12": 12, "e26": 26}
    a = {k: 2.0 / (s + 1.0) for k, s in spans.items()}
    a9 = 2.0 / 10.0

    def lit(x: float) -> str:
        return f"CAST({x!r} AS DOUBLE)"

    seed = ", ".join(f"Close AS {k}" for k in spans)
    step = ", ".join(f"{lit(1 - a[k])} * e.{k} + {lit(a[k])} * s.Close" for k in spans)
    macd_new = (f"(({lit(1 - a['e12'])} * e.e12 + {lit(a['e12'])} * s.Close) - "
                f"({lit(1 - a['e26'])} * e.e26 + {lit(a['e26'])} * s.Close))")
    where = "" if keep_incomplete else """
      WHERE "return" IS NOT NULL AND log_return IS NOT NULL AND sma_5 IS NOT NULL
        AND sma_10 IS NOT NULL AND sma_20 IS NOT NULL AND vol_10 IS NOT NULL AND rsi_14 IS NOT NULL
        AND lag_close_1 IS NOT NULL AND lag_close_2 IS NOT NULL AND lag_close_3 IS NOT NULL
        AND lag_close_5 IS NOT NULL AND lag_return_1 IS NOT NULL AND lag_return_2 IS NOT NULL
        AND lag_return_3 IS NOT NULL AND lag_return_5 IS NOT NULL"""
    return f"""
    WITH RECURSIVE bars AS ({bars_sql(key)}),
    s AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS rn FROM bars),
    e AS (
      SELECT ticker, rn, {seed}, CAST(0.0 AS DOUBLE) AS macd_signal FROM s WHERE rn = 0
      UNION ALL
      SELECT s.ticker, s.rn, {step},
             {lit(1 - a9)} * e.macd_signal + {lit(a9)} * {macd_new}
      FROM e JOIN s ON s.ticker = e.ticker AND s.rn = e.rn + 1
    ),
    t1 AS (
      SELECT s.*, e.ema_5, e.ema_10, e.ema_20, e.e12 - e.e26 AS macd, e.macd_signal,
             Close / lag(Close, 1) OVER w - 1 AS "return",
             ln(Close) - lag(ln(Close), 1) OVER w AS log_return,
             Close - lag(Close, 1) OVER w AS delta,
             CASE WHEN count(Close) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) = 5
                  THEN avg(Close) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) END AS sma_5,
             CASE WHEN count(Close) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) = 10
                  THEN avg(Close) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) END AS sma_10,
             CASE WHEN count(Close) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 20
                  THEN avg(Close) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END AS sma_20,
             lag(Close, 1) OVER w AS lag_close_1, lag(Close, 2) OVER w AS lag_close_2,
             lag(Close, 3) OVER w AS lag_close_3, lag(Close, 5) OVER w AS lag_close_5
      FROM s JOIN e USING (ticker, rn)
      WINDOW w AS (PARTITION BY s.ticker ORDER BY s.date)
    ),
    t2 AS (
      SELECT t1.*,
             CASE WHEN count("return") OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) = 10
                  THEN stddev_samp("return") OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) END AS vol_10,
             100.0 - 100.0 / (1.0 +
               (CASE WHEN count(delta) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) = 14
                     THEN avg(CASE WHEN delta IS NOT NULL THEN greatest(delta, 0.0) END)
                          OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) END)
               / ((CASE WHEN count(delta) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) = 14
                     THEN avg(CASE WHEN delta IS NOT NULL THEN -least(delta, 0.0) END)
                          OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) END) + 1e-9)) AS rsi_14,
             lag("return", 1) OVER w AS lag_return_1, lag("return", 2) OVER w AS lag_return_2,
             lag("return", 3) OVER w AS lag_return_3, lag("return", 5) OVER w AS lag_return_5
      FROM t1
      WINDOW w AS (PARTITION BY ticker ORDER BY date)
    )
    SELECT ticker, date, Open, High, Low, Close, Adj_Close, Volume, "return", log_return,
           sma_5, ema_5, sma_10, ema_10, sma_20, ema_20, vol_10, rsi_14, macd, macd_signal,
           macd - macd_signal AS macd_hist, lag_close_1, lag_return_1, lag_close_2, lag_return_2,
           lag_close_3, lag_return_3, lag_close_5, lag_return_5
    FROM t2 {where}"""


def rounded_select(cols: list[str], digits: dict[str, int] | None = None,
                   default: int = 6, passthrough: tuple = ()) -> str:
    """``floor(x*1eD+0.5)/1eD AS x`` for every double column in ``cols``."""
    digits = digits or {}
    out = []
    for c in cols:
        q = f'"{c}"'
        if c in passthrough:
            out.append(q)
        else:
            out.append(R(q, q, digits.get(c, default)))
    return ", ".join(out)
