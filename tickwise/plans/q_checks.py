"""Checked queries for the data-quality / drift / performance gates (DQ-*)."""
from __future__ import annotations

from pyspark.sql import Window, functions as F

from tickwise.functions.exprs import present
from tickwise.operators import checks as C
from tickwise.operators import metrics as M
from tickwise.operators.timeseries import FEATURE_COLUMNS, feature_matrix
from tickwise.plans.catalog import register
from tickwise.plans.q_metrics import scored, scored_sql
from tickwise.plans.q_timeseries import features
from tickwise.plans.sqlparts import R, features_sql
from tickwise.sources.bars import bars_from_lineitem
from tickwise.sources.tables import read_table

NUMERIC = [c for c in FEATURE_COLUMNS if c != "date"]
FEAT_ALL = f"({features_sql(keep_incomplete=True)})"
_MISS = " + ".join(f'avg(CASE WHEN "{c}" IS NULL OR isnan("{c}") OR isinf("{c}") THEN 1.0 ELSE 0.0 END)' for c in NUMERIC)
_ALLCOLS = ", ".join(f'"{c}"' for c in FEATURE_COLUMNS)


@register("integrity_checks", "DQ-01, AG-10, AG-11, AG-12", f"""
    WITH f AS (SELECT ticker, {_ALLCOLS} FROM {FEAT_ALL}),
    a AS (SELECT ticker, count(*) AS n_rows, ({_MISS}) / {float(len(NUMERIC))!r} AS mr FROM f GROUP BY ticker),
    d AS (SELECT ticker, sum(c - 1) AS dups FROM (SELECT *, count(*) AS c FROM f GROUP BY ALL) GROUP BY ticker)
    SELECT ticker, x.name AS name, x.severity AS severity, {R('x.value', 'value')} FROM (
      SELECT ticker, unnest([
        struct_pack(name := 'file_non_empty', severity := CASE WHEN n_rows > 0 THEN 'ok' ELSE 'severe' END,
                    value := CAST(n_rows AS DOUBLE)),
        struct_pack(name := 'missingness', severity := CASE WHEN mr > 0.30 THEN 'severe' WHEN mr > 0.10 THEN 'warning' ELSE 'ok' END,
                    value := mr),
        struct_pack(name := 'duplicate_rows', severity := CASE WHEN dups > 0 THEN 'warning' ELSE 'ok' END,
                    value := CAST(dups AS DOUBLE))]) AS x
      FROM a JOIN d USING (ticker))""")
def q_integrity(spark, sf):
    f = feature_matrix(bars_from_lineitem(spark, sf), drop_incomplete=False)
    return present(C.integrity_checks(f, NUMERIC).drop("details"))


@register("date_monotonic_events", "DQ-02", """
    SELECT event_type, CAST(sum(CASE WHEN ts < prev THEN 1 ELSE 0 END) AS BIGINT) AS n_violations,
           CAST(count(*) AS BIGINT) AS n_rows
    FROM (SELECT event_type, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY event_id) AS prev
          FROM events WHERE ts IS NOT NULL) GROUP BY event_type""")
def q_monotonic(spark, sf):
    # small order buckets so that bucket boundaries are exercised at test scale
    e = read_table(spark, sf, "events")
    return C.monotonic_violations(e, "event_id", "ts", ["event_type"], bucket=1000)


def _halves(spark, sf, key="l_returnflag"):
    from tickwise.session import materialize
    f = features(spark, sf, key)
    w = Window.partitionBy("ticker").orderBy("date")
    f = materialize(f.withColumn("_rn", F.row_number().over(w)).withColumn(
        "_n", F.count(F.lit(1)).over(Window.partitionBy("ticker"))))
    base = f.where(F.col("_rn") <= F.floor(F.col("_n") / 2)).drop("_rn", "_n")
    cur = f.where(F.col("_rn") > F.floor(F.col("_n") / 2)).drop("_rn", "_n")
    return base, cur


DRIFT_COLS = [c for c in FEATURE_COLUMNS if c != "date"]


def _ks_sql(key="l_returnflag") -> str:
    items = ", ".join(f"struct_pack(feature := '{c}', v := CASE WHEN isnan(CAST(\"{c}\" AS DOUBLE)) OR "
                      f"isinf(CAST(\"{c}\" AS DOUBLE)) THEN NULL ELSE CAST(\"{c}\" AS DOUBLE) END)"
                      for c in DRIFT_COLS)
    lam = "((sqrt(nx * ny / (nx + ny)) + 0.12 + 0.11 / sqrt(nx * ny / (nx + ny))) * ks_d)"
    term = f"2.0 * (CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * CAST(j * j AS DOUBLE) * ({lam} * {lam}))"
    return f"""
    WITH f AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) AS r,
                         count(*) OVER (PARTITION BY ticker) AS n FROM ({features_sql(key)})),
    u AS (SELECT ticker, kv.feature AS feature, kv.v AS v, side FROM (
            SELECT ticker, CASE WHEN r <= floor(n / 2) THEN 0 ELSE 1 END AS side, unnest([{items}]) AS kv FROM f)),
    c AS (SELECT ticker, feature, v,
                 CAST(sum(CASE WHEN v IS NOT NULL AND side = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS cx,
                 CAST(sum(CASE WHEN v IS NOT NULL AND side = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS cy
          FROM u GROUP BY ALL),
    s AS (SELECT ticker, feature,
                 sum(cx) OVER (PARTITION BY ticker, feature ORDER BY v ROWS UNBOUNDED PRECEDING) AS sx,
                 sum(cy) OVER (PARTITION BY ticker, feature ORDER BY v ROWS UNBOUNDED PRECEDING) AS sy,
                 sum(cx) OVER (PARTITION BY ticker, feature) AS nx, sum(cy) OVER (PARTITION BY ticker, feature) AS ny
          FROM c),
    k AS (SELECT ticker, feature, CASE WHEN max(nx) > 0 AND max(ny) > 0 THEN max(abs(sx / nx - sy / ny)) ELSE 0.0 END AS ks_d,
                 max(nx) AS nx, max(ny) AS ny FROM s GROUP BY ticker, feature),
    p AS (SELECT *, CASE WHEN nx <= 0 OR ny <= 0 THEN 1.0 WHEN {lam} <= 0 THEN 1.0 ELSE
            least(greatest(list_sum(list_slice(list_transform(range(1, 101), lambda j: {term}), 1,
              coalesce(list_min(list_filter(range(1, 101), lambda j: abs({term}) < 1e-10)), 100))), 0.0), 1.0) END AS p_value
          FROM k)"""


KS_SQL = _ks_sql()


@register("ks_drift_columns", "DQ-03, DQ-04, ST-01, JN-06", f"""{KS_SQL}
    SELECT ticker, feature, {R('ks_d', 'ks_d')}, CAST(nx AS BIGINT) AS n_base, CAST(ny AS BIGINT) AS n_cur,
           {R('p_value', 'p_value')}, (p_value < 0.001 AND ks_d > 0.15) AS is_severe FROM p""")
def q_ks(spark, sf):
    base, cur = _halves(spark, sf)
    return present(C.drift_columns(base, cur, DRIFT_COLS))


@register("drift_verdict", "DQ-05", f"""{KS_SQL}
    SELECT ticker, CAST(count(*) AS BIGINT) AS shared_columns,
           CAST(sum(CASE WHEN p_value < 0.001 AND ks_d > 0.15 THEN 1 ELSE 0 END) AS BIGINT) AS severe_count,
           {R('sum(CASE WHEN p_value < 0.001 AND ks_d > 0.15 THEN 1 ELSE 0 END) / greatest(count(*), 1)', 'fraction_severe')},
           CASE WHEN sum(CASE WHEN p_value < 0.001 AND ks_d > 0.15 THEN 1 ELSE 0 END) / greatest(count(*), 1) >= 0.25 THEN 'severe'
                WHEN sum(CASE WHEN p_value < 0.001 AND ks_d > 0.15 THEN 1 ELSE 0 END) > 0 THEN 'warning' ELSE 'ok' END AS severity,
           coalesce(array_to_string(list_sort(list(CASE WHEN p_value < 0.001 AND ks_d > 0.15 THEN feature END)
                                     FILTER (WHERE p_value < 0.001 AND ks_d > 0.15)), ','), '') AS severe_features
    FROM p GROUP BY ticker""")
def q_drift_verdict(spark, sf):
    base, cur = _halves(spark, sf)
    v = C.drift_verdict(C.drift_columns(base, cur, DRIFT_COLS))
    return present(v.withColumn("severe_features", F.array_join("severe_features", ",")))


S100 = scored_sql("l_suppkey")
GATES_SQL = f"""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn,
                         count(*) OVER (PARTITION BY ticker) AS n
               FROM {S100} WHERE target_return IS NOT NULL AND "return" IS NOT NULL),
    stored AS (SELECT ticker, sqrt(avg((target_return - "return") * (target_return - "return"))) AS brmse
               FROM r WHERE rn <= floor(n * 0.8) GROUP BY ticker),
    reg AS (SELECT ticker, max(n) AS n_rows, sqrt(avg((target_return - "return") * (target_return - "return"))) AS rmse
            FROM r WHERE rn > floor(n * 0.8) GROUP BY ticker),
    c AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn,
                    count(*) OVER (PARTITION BY ticker) AS n FROM {S100}),
    t AS (SELECT * FROM c WHERE rn > floor(n * 0.8)),
    ll AS (SELECT ticker, max(n) AS n_rows, avg(-(y * ln(p + 1e-15) + (1 - y) * ln(1 - p + 1e-15))) AS logloss FROM t GROUP BY ticker),
    sc AS (SELECT ticker, p, sum(y) AS pos, sum(1 - y) AS neg FROM t GROUP BY ticker, p),
    cc AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY ticker ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM sc),
    auc AS (SELECT ticker, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)) END AS auc
            FROM cc GROUP BY ticker),
    checks AS (
      SELECT reg.ticker, 'regressor_performance' AS name,
             CASE WHEN n_rows < 50 THEN 'warning'
                  WHEN (CASE WHEN brmse > 0 THEN rmse > brmse * 3.0 ELSE rmse > 0.10 END) THEN 'severe' ELSE 'ok' END AS severity,
             rmse AS value
      FROM reg LEFT JOIN stored USING (ticker)
      UNION ALL
      SELECT ll.ticker, 'classifier_performance',
             CASE WHEN n_rows < 50 THEN 'warning' WHEN logloss > 1.0 OR coalesce(auc < 0.5, false) THEN 'severe' ELSE 'ok' END,
             logloss
      FROM ll LEFT JOIN auc USING (ticker))"""


def _gates(spark, sf):
    from tickwise.session import materialize
    s = materialize(scored(spark, sf, "l_suppkey").select("ticker", "date", "return", "target_return", "y", "p"))
    reg_rows = s.where(F.col("target_return").isNotNull() & F.col("return").isNotNull())
    w = Window.partitionBy("ticker").orderBy("date")
    tr = (reg_rows.withColumn("_rn", F.row_number().over(w))
          .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("ticker")))
          .where(F.col("_rn") <= F.floor(F.col("_n") * 0.8)))
    stored = M.regression_metrics(tr, "target_return", "return")
    return C.union_checks(C.regressor_gate(reg_rows, "target_return", "return", stored),
                          C.classifier_gate(s, "y", "p"))


@register("performance_gates", "DQ-07, DQ-08, AG-01, AG-03, AG-04",
          f"{GATES_SQL} SELECT ticker, name, severity, {R('value', 'value')} FROM checks")
def q_gates(spark, sf):
    return present(_gates(spark, sf).drop("details"))


@register("overall_status", "DQ-10", f"""{GATES_SQL}
    SELECT ticker, CASE max(CASE severity WHEN 'severe' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END)
                     WHEN 2 THEN 'severe' WHEN 1 THEN 'warning' ELSE 'ok' END AS overall_status,
           CAST(count(*) AS BIGINT) AS n_checks
    FROM checks GROUP BY ticker""")
def q_overall(spark, sf):
    return C.overall_status(_gates(spark, sf))


_MEANS = ", ".join(f"avg(CASE WHEN isnan(CAST(\"{c}\" AS DOUBLE)) OR isinf(CAST(\"{c}\" AS DOUBLE)) THEN NULL "
                   f"ELSE CAST(\"{c}\" AS DOUBLE) END) AS \"{c}\"" for c in DRIFT_COLS)


def _side_means(side_pred: str) -> str:
    items = ", ".join(f"struct_pack(feature := '{c}', m := \"{c}\")" for c in DRIFT_COLS)
    return f"""(SELECT ticker, x.feature AS feature, x.m AS m FROM (
        SELECT ticker, unnest([{items}]) AS x FROM (
          SELECT ticker, {_MEANS} FROM f WHERE {side_pred} GROUP BY ticker)))"""


@register("drift_profile", "AG-20, DQ-03, DQ-04", f"""{KS_SQL},
    rm AS {_side_means('r <= floor(n / 2)')}, cm AS {_side_means('r > floor(n / 2)')}
    SELECT p.ticker, p.feature, {R('ks_d', 'ks_d')}, {R('p_value', 'p_value')},
           (p_value < 0.001 AND ks_d > 0.15) AS is_severe, {R('rm.m', 'reference_mean')}, {R('cm.m', 'current_mean')},
           CAST(sum(CASE WHEN p_value < 0.001 AND ks_d > 0.15 THEN 1 ELSE 0 END) OVER (PARTITION BY p.ticker) AS BIGINT)
             AS severe_count
    FROM p JOIN rm ON rm.ticker = p.ticker AND rm.feature = p.feature
           JOIN cm ON cm.ticker = p.ticker AND cm.feature = p.feature""")
def q_drift_profile(spark, sf):
    base, cur = _halves(spark, sf)
    d = C.drift_profile(base, cur, DRIFT_COLS)
    return present(d.select("ticker", "feature", "ks_d", "p_value", "is_severe", "reference_mean", "current_mean",
                            "severe_count"))


@register("drift_unsupported", "DQ-06")
def q_drift_unsupported(spark, sf):
    base, cur = _halves(spark, sf)
    unknown = C.drift_checks(base, cur, metric="psi")
    no_shared = C.drift_checks(base.select("ticker", "date"), cur.select("ticker", "date"))
    return C.union_checks(unknown, no_shared).drop("details")


@register("check_run_status", "DQ-10, DQ-01, DQ-05, SRC-16", f"""{KS_SQL},
    v AS (SELECT ticker, CASE WHEN sum(CASE WHEN p_value < 0.001 AND ks_d > 0.15 THEN 1 ELSE 0 END) / greatest(count(*), 1) >= 0.25 THEN 'severe'
                              WHEN sum(CASE WHEN p_value < 0.001 AND ks_d > 0.15 THEN 1 ELSE 0 END) > 0 THEN 'warning' ELSE 'ok' END AS severity
          FROM p GROUP BY ticker)
    SELECT ticker, CASE WHEN ticker = 'R' THEN 'ok' ELSE severity END AS overall_status, CAST(4 AS BIGINT) AS n_checks FROM v
    UNION ALL SELECT 'no-rows', 'severe', CAST(3 AS BIGINT)""")
def q_check_run(spark, sf):
    """A later half against the stored first half: R has no baseline yet, one expected ticker has no rows."""
    base, cur = _halves(spark, sf)
    base = base.where(F.col("ticker") != "R")
    tickers = cur.select("ticker").distinct()
    expected = tickers.unionByName(tickers.select(F.lit("no-rows").alias("ticker")))
    fresh = tickers.join(base.select("ticker").distinct(), "ticker", "left_anti")
    return C.overall_status(C.check_run(cur, NUMERIC, base, fresh, expected=expected))
