"""Checked queries for ARIMA fitting and forecasting (ML-23 … ML-25, TS-19)."""
from __future__ import annotations

import math

from tickwise.functions.exprs import present
from tickwise.operators import forecast as FC
from tickwise.plans.catalog import register
from tickwise.plans.sqlparts import R
from tickwise.sources.bars import bars_from_lineitem, bars_sql


def _css(d: str, phi: str, theta: str) -> str:
    e = f"(x - {phi} * acc.pd - {theta} * acc.pe)"
    return (f"list_reduce(list_slice({d}, 2, len({d})), lambda acc, x: struct_pack(pd := x, pe := {e}, "
            f"s := acc.s + {e} * {e}, a := acc.a + abs({e})), struct_pack(pd := {d}[1], "
            f"pe := CAST(0 AS DOUBLE), s := CAST(0 AS DOUBLE), a := CAST(0 AS DOUBLE)))")


def arima_sql() -> str:
    return f"""
    WITH b AS ({bars_sql()}),
    fq AS (SELECT ticker, CASE WHEN count(*) < 3 THEN 'D'
           WHEN coalesce(max(CASE WHEN gap <> 1 THEN 1 ELSE 0 END), 0) = 0 THEN 'D'
           WHEN coalesce(max(CASE WHEN dow IN (0, 6) THEN 1 ELSE 0 END), 0) = 0
            AND coalesce(max(CASE WHEN gap NOT IN (1, 3) THEN 1 ELSE 0 END), 0) = 0
            AND coalesce(max(CASE WHEN gap = 3 AND dow <> 1 THEN 1 ELSE 0 END), 0) = 0
            AND coalesce(max(CASE WHEN gap = 1 AND dow = 1 THEN 1 ELSE 0 END), 0) = 0 THEN 'B'
           WHEN coalesce(max(CASE WHEN gap <> 7 THEN 1 ELSE 0 END), 0) = 0 THEN 'W' ELSE 'D' END AS freq
         FROM (SELECT ticker, date, dayofweek(date) AS dow,
                      date - lag(date) OVER (PARTITION BY ticker ORDER BY date) AS gap FROM b) GROUP BY ticker),
    span AS (SELECT ticker, min(date) AS d0, max(date) AS d1 FROM b GROUP BY ticker),
    grid0 AS (SELECT ticker, freq, CAST(d0 + CAST(unnest(range(0, (d1 - d0) + 1,
                       CASE WHEN freq = 'W' THEN 7 ELSE 1 END)) AS INTEGER) AS DATE) AS date
              FROM span JOIN fq USING (ticker)),
    grid AS (SELECT ticker, date FROM grid0 WHERE freq <> 'B' OR dayofweek(date) NOT IN (0, 6)),
    dense AS (SELECT ticker, date, last_value(b.Close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM grid LEFT JOIN b USING (ticker, date)),
    s AS (SELECT ticker, max(date) AS last_date, count(*) AS n_levels, list(v ORDER BY date) AS lv
          FROM dense GROUP BY ticker HAVING count(*) >= 3),
    d AS (SELECT ticker, last_date, n_levels, lv[len(lv)] AS last_obs,
                 list_transform(list_slice(lv, 2, len(lv)), lambda x, i: x - lv[i]) AS d FROM s),
    g1 AS (SELECT ticker, d, CAST(i - 19 AS DOUBLE) / 20.0 AS phi, CAST(j - 19 AS DOUBLE) / 20.0 AS theta
           FROM d, range(0, 39) r1(i), range(0, 39) r2(j)),
    b1 AS (SELECT ticker, min(struct_pack(s := sse, phi := phi, theta := theta)) AS best FROM (
             SELECT ticker, phi, theta, {_css('d', 'phi', 'theta')}.s AS sse FROM g1
             WHERE abs(phi) < 1 AND abs(theta) < 1) GROUP BY ticker),
    g2 AS (SELECT d.ticker, d.d, b1.best.phi + CAST(i - 10 AS DOUBLE) / 200.0 AS phi,
                  b1.best.theta + CAST(j - 10 AS DOUBLE) / 200.0 AS theta
           FROM d JOIN b1 USING (ticker), range(0, 21) r1(i), range(0, 21) r2(j)),
    b2 AS (SELECT ticker, min(struct_pack(s := sse, phi := phi, theta := theta)) AS best FROM (
             SELECT ticker, phi, theta, {_css('d', 'phi', 'theta')}.s AS sse FROM g2
             WHERE abs(phi) < 1 AND abs(theta) < 1) GROUP BY ticker),
    g3 AS (SELECT d.ticker, d.d, b2.best.phi + CAST(i - 10 AS DOUBLE) / 2000.0 AS phi,
                  b2.best.theta + CAST(j - 10 AS DOUBLE) / 2000.0 AS theta
           FROM d JOIN b2 USING (ticker), range(0, 21) r1(i), range(0, 21) r2(j)),
    b3 AS (SELECT ticker, min(struct_pack(s := sse, phi := phi, theta := theta)) AS best FROM (
             SELECT ticker, phi, theta, {_css('d', 'phi', 'theta')}.s AS sse FROM g3
             WHERE abs(phi) < 1 AND abs(theta) < 1) GROUP BY ticker),
    st AS (SELECT d.*, b3.best.phi AS phi, b3.best.theta AS theta, len(d.d) - 1 AS n_resid,
                  {_css('d.d', 'b3.best.phi', 'b3.best.theta')} AS fs
           FROM d JOIN b3 USING (ticker)),
    fit AS (SELECT st.ticker, fq.freq, phi, theta, fs.s / n_resid AS sigma2, fs.s AS sse, n_resid,
                   -n_resid / 2.0 * (ln({2 * math.pi!r} * (fs.s / n_resid)) + 1.0) AS ll,
                   sqrt(fs.s / n_resid) AS rmse, fs.a / n_resid AS mae, last_obs, last_date,
                   d[len(d)] AS last_diff, fs.pe AS last_resid FROM st JOIN fq USING (ticker))"""


ARIMA_SQL = arima_sql()


def _fit(spark, sf):
    return FC.fit_arima(bars_from_lineitem(spark, sf))


@register("arima_fit", "ML-23, ML-25, TS-16", f"""{ARIMA_SQL}
    SELECT ticker, {R('phi', 'phi')}, {R('theta', 'theta')}, {R('sigma2', 'sigma2')},
           CAST(n_resid AS BIGINT) AS n_resid, {R('ll', 'log_likelihood')}, {R('-2.0 * ll + 6.0', 'aic')},
           {R('-2.0 * ll + 3.0 * ln(n_resid)', 'bic')}, {R('rmse', 'rmse')}, {R('mae', 'mae')},
           {R('last_obs', 'last_obs')}
    FROM fit""")
def q_arima_fit(spark, sf):
    f = _fit(spark, sf)
    return present(f.select("ticker", "phi", "theta", "sigma2", "n_resid", "log_likelihood", "aic", "bic",
                            "rmse", "mae", "last_obs"))


_BDAY = ("(CASE dayofweek(last_date) WHEN 6 THEN last_date - 1 WHEN 0 THEN last_date - 2 ELSE last_date END"
         " + CAST(step + 2 * floor(((dayofweek(CASE dayofweek(last_date) WHEN 6 THEN last_date - 1 WHEN 0 "
         "THEN last_date - 2 ELSE last_date END) + 6) % 7 + step) / 5) AS INTEGER))")
_PSI = "(CASE WHEN j = 0 THEN 1.0 ELSE 1.0 + (phi + theta) * (1.0 - pow(phi, j)) / (1.0 - phi) END)"


@register("arima_forecast", "ML-24, TS-19", f"""{ARIMA_SQL},
    steps AS (SELECT *, unnest(range(1, 8)) AS step, phi * last_diff + theta * last_resid AS d1 FROM fit),
    lv AS (SELECT *, last_obs + d1 * (1.0 - pow(phi, step)) / (1.0 - phi) AS lvl,
                  1.96 * sqrt(sigma2) * sqrt(list_sum(list_transform(range(0, step), lambda j: {_PSI} * {_PSI}))) AS half
           FROM steps)
    SELECT ticker, CAST(step AS BIGINT) AS step,
           CASE WHEN freq = 'B' THEN {_BDAY}
                WHEN freq = 'W' THEN CAST(last_date + CAST(7 * step AS INTEGER) AS DATE)
                ELSE CAST(last_date + CAST(step AS INTEGER) AS DATE) END AS date,
           {R('lvl', 'prediction')}, {R('lvl - half', 'lower')}, {R('lvl + half', 'upper')} FROM lv""")
def q_arima_forecast(spark, sf):
    return present(FC.forecast(_fit(spark, sf), 7))
