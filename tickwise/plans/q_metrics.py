"""Checked queries for aggregations and metrics (AG-*)."""
from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.functions.exprs import present
from tickwise.operators import metrics as M
from tickwise.operators.timeseries import FEATURE_COLUMNS, by_date, feature_matrix
from tickwise.plans.catalog import register
from tickwise.plans.q_timeseries import features
from tickwise.plans.sqlparts import R, features_sql
from tickwise.sources.bars import bars_from_lineitem
from tickwise.sources.tables import read_table

NUMERIC = [c for c in FEATURE_COLUMNS if c not in ("date",)]


def scored(spark, sf, key="l_returnflag"):
    """Deterministic score table: p = rsi_14 / 100 as P(up), y = next close
    return > 0 (ML-01 label), regression target = next return, persistence
    prediction = today's return."""
    f = features(spark, sf, key)
    w = by_date()
    nxt = F.try_divide(F.lead("Close").over(w) - F.col("Close"), F.col("Close"))
    return (f.select("*", nxt.alias("next_return"), F.lead("return").over(w).alias("target_return"))
            .where(F.col("next_return").isNotNull())
            .withColumn("y", (F.col("next_return") > 0).cast("int"))
            .withColumn("p", F.col("rsi_14") / 100.0))


def scored_sql(key="l_returnflag") -> str:
    return f"""(SELECT * , CAST(next_return > 0 AS INTEGER) AS y, rsi_14 / 100.0 AS p FROM (
        SELECT *, (lead(Close) OVER w - Close) / Close AS next_return, lead("return") OVER w AS target_return
        FROM ({features_sql(key)}) WINDOW w AS (PARTITION BY ticker ORDER BY date)) WHERE next_return IS NOT NULL)"""


S3, S100 = scored_sql(), scored_sql("l_suppkey")
FEAT_ALL = f"({features_sql(keep_incomplete=True)})"


@register("regression_metrics", "AG-01", f"""
    SELECT ticker, {R('sqrt(avg((target_return - "return") * (target_return - "return")))', 'rmse')},
           {R('avg(abs(target_return - "return"))', 'mae')}, count(*) AS n
    FROM {S100} WHERE target_return IS NOT NULL GROUP BY ticker""")
def q_regression(spark, sf):
    return present(M.regression_metrics(scored(spark, sf, "l_suppkey"), "target_return", "return"))


@register("naive_baseline", "AG-02", f"""
    SELECT ticker, {R('sqrt(avg(target_return * target_return))', 'rmse_zero')},
           {R('avg(abs(target_return))', 'mae_zero')}, {R('stddev_pop(target_return)', 'std_target')},
           count(*) AS n
    FROM {S100} WHERE target_return IS NOT NULL GROUP BY ticker""")
def q_naive(spark, sf):
    return present(M.naive_baseline(scored(spark, sf, "l_suppkey"), "target_return"))


@register("classification_metrics", "AG-03, AG-05, ML-01", f"""
    SELECT ticker, {R('avg(-(y * ln(p + 1e-15) + (1 - y) * ln(1 - p + 1e-15)))', 'logloss')},
           {R('avg((p - y) * (p - y))', 'brier')}, count(*) AS n
    FROM {S100} GROUP BY ticker""")
def q_classification(spark, sf):
    return present(M.classification_metrics(scored(spark, sf, "l_suppkey"), "y", "p"))


AUC_SQL = f"""
    WITH s AS (SELECT ticker, p, sum(y) AS pos, sum(1 - y) AS neg FROM {S100} GROUP BY ticker, p),
    c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY ticker ORDER BY p
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM s)
    SELECT ticker, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                   THEN {R('sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg))', 'x').replace(' AS x', '')} END AS auc,
           CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
    FROM c GROUP BY ticker"""


@register("roc_auc", "AG-04", AUC_SQL)
def q_auc(spark, sf):
    return present(M.roc_auc(scored(spark, sf, "l_suppkey"), "y", "p"))


_INNER = "[0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9]"
_ALL = "[0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]"


@register("calibration_report", "AG-06, AG-08, AG-09", f"""
    SELECT *, CASE WHEN prob_pred IS NULL OR prob_true IS NULL THEN 'Mixed'
                   WHEN abs(prob_pred - prob_true) <= 0.03 THEN 'Good'
                   WHEN prob_pred - prob_true > 0.05 THEN 'Over'
                   WHEN prob_pred - prob_true < -0.05 THEN 'Under' ELSE 'Mixed' END AS assessment,
           {R('greatest(0.0, prob_pred - 1.96 * sqrt(prob_pred * (1 - prob_pred) / greatest(1, n)))', 'band_lower')},
           {R('least(1.0, prob_pred + 1.96 * sqrt(prob_pred * (1 - prob_pred) / greatest(1, n)))', 'band_upper')}
    FROM (SELECT ticker, CAST(len(list_filter({_INNER}, lambda e: e < p)) + 1 AS BIGINT) AS bin,
                 {R('avg(y)', 'prob_true')}, {R('avg(p)', 'prob_pred')}, count(*) AS n
          FROM {S3} GROUP BY ALL)""")
def q_calibration(spark, sf):
    c = M.calibration_curve(scored(spark, sf), "y", "p")
    c = present(c)  # round first: assessment and band use the reported values
    lo, hi, _ = M.prob_band(F.col("prob_pred"), F.col("n"))
    return present(c.select("*", M.assess_bin(F.col("prob_pred"), F.col("prob_true")).alias("assessment"),
                            lo.alias("band_lower"), hi.alias("band_upper")))


@register("calibration_manual", "AG-07", f"""
    WITH r AS (SELECT ticker, CAST(len(list_filter({_ALL}, lambda e: e <= p)) - 1 AS BIGINT) AS bin, y, p FROM {S3}),
    a AS (SELECT ticker, bin, avg(y) AS prob_true, avg(p) AS pp, count(*) AS n FROM r WHERE bin BETWEEN 0 AND 9 GROUP BY ALL),
    g AS (SELECT ticker, CAST(unnest(range(0, 10)) AS BIGINT) AS bin FROM (SELECT DISTINCT ticker FROM {S3}))
    SELECT g.ticker, g.bin, {R('a.prob_true', 'prob_true')},
           {R(f'coalesce(a.pp, ({_ALL}[g.bin + 1] + {_ALL}[g.bin + 2]) / 2.0)', 'prob_pred')},
           CAST(coalesce(a.n, 0) AS BIGINT) AS n
    FROM g LEFT JOIN a USING (ticker, bin)""")
def q_calibration_manual(spark, sf):
    return present(M.calibration_manual(scored(spark, sf), "y", "p"))


@register("table_shape", "AG-10", f"""
    SELECT ticker, count(*) AS n_rows, CAST({len(FEATURE_COLUMNS) + 1} AS BIGINT) AS n_cols FROM {FEAT_ALL} GROUP BY ticker""")
def q_shape(spark, sf):
    f = feature_matrix(bars_from_lineitem(spark, sf), drop_incomplete=False)
    return M.shape(f)


_MISS = " + ".join(f'avg(CASE WHEN "{c}" IS NULL OR isnan("{c}") OR isinf("{c}") THEN 1.0 ELSE 0.0 END)' for c in NUMERIC)


@register("missing_rate", "AG-11", f"""
    SELECT ticker, {R(f'({_MISS}) / {float(len(NUMERIC))!r}', 'missing_rate')} FROM {FEAT_ALL} GROUP BY ticker""")
def q_missing(spark, sf):
    f = feature_matrix(bars_from_lineitem(spark, sf), drop_incomplete=False)
    return present(M.missing_rate(f, NUMERIC))


@register("duplicate_rows", "AG-12", """
    SELECT source, CAST(sum(c - 1) AS BIGINT) AS n_duplicates, CAST(sum(c) AS BIGINT) AS n_rows
    FROM (SELECT source, text, lang, count(*) AS c FROM documents GROUP BY ALL) GROUP BY source""")
def q_duplicates(spark, sf):
    d = read_table(spark, sf, "documents")
    return M.duplicate_rows(d, ["text", "lang"], group=["source"])


@register("volume_quantile", "AG-13", f"""
    SELECT ticker, {R('quantile_cont(Volume, 0.8)', 'q80')} FROM ({features_sql('l_suppkey')}) GROUP BY ticker""")
def q_quantile(spark, sf):
    return present(M.quantile(features(spark, sf, "l_suppkey"), "Volume", 0.8))


_CORR_COLS = [c for c in NUMERIC if c != "ticker"]


def _corr_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i:]]
    aggs = ", ".join(f'coalesce(corr("{a}", "{b}"), 0.0) AS "{a}__{b}"' for a, b in pairs)
    items = []
    for a, b in pairs:
        items.append(f"struct_pack(a := '{a}', b := '{b}', c := \"{a}__{b}\")")
        if a != b:
            items.append(f"struct_pack(a := '{b}', b := '{a}', c := \"{a}__{b}\")")
    return f"""SELECT ticker, x.a AS a, x.b AS b, {R('x.c', 'corr')} FROM (
        SELECT ticker, unnest([{', '.join(items)}]) AS x FROM (
          SELECT ticker, {aggs} FROM ({features_sql()}) GROUP BY ticker))"""


@register("correlation_matrix", "AG-14", _corr_sql())
def q_corr(spark, sf):
    return present(M.correlation_long(features(spark, sf), _CORR_COLS))


@register("next_return_summary", "AG-15, AG-16", f"""
    SELECT ticker, {R('avg(next_return)', 'mean')}, {R('quantile_cont(next_return, 0.5)', 'median')},
           {R('stddev_pop(next_return)', 'std')}, {R('min(next_return)', 'min')}, {R('max(next_return)', 'max')},
           {R('round(100.0 * avg(CASE WHEN next_return > 0 THEN 1.0 ELSE 0.0 END))', 'pct_positive')},
           count(*) AS n
    FROM {S100} GROUP BY ticker""")
def q_summary(spark, sf):
    return present(M.value_summary(scored(spark, sf, "l_suppkey"), "next_return"))


@register("next_return_histogram", "AG-17", f"""
    WITH b AS (SELECT ticker, next_return AS v FROM {S3}),
    r AS (SELECT ticker, min(v) AS mn, greatest((max(v) - min(v)) / 5, 1e-6) AS width FROM b GROUP BY ticker),
    c AS (SELECT b.ticker, least(floor((v - mn) / width), 4) AS bin, count(*) AS n FROM b JOIN r USING (ticker) GROUP BY ALL),
    g AS (SELECT ticker, mn, width, unnest(range(0, 5)) AS bin FROM r)
    SELECT g.ticker, CAST(g.bin AS BIGINT) AS bin, {R('mn + width * (g.bin + 0.5)', 'midpoint')},
           CAST(coalesce(c.n, 0) AS BIGINT) AS n
    FROM g LEFT JOIN c ON g.ticker = c.ticker AND g.bin = c.bin""")
def q_histogram(spark, sf):
    return present(M.histogram(scored(spark, sf), "next_return"))


def _profile_sql() -> str:
    types = {"date": "date", "Volume": "bigint"}
    parts = []
    for c in FEATURE_COLUMNS:
        parts.append(f"struct_pack(feature := '{c}', dtype := '{types.get(c, 'double')}', "
                     f"null_count := count(*) FILTER (WHERE \"{c}\" IS NULL))")
    return f"""SELECT ticker, x.feature AS feature, x.dtype AS dtype, CAST(x.null_count AS BIGINT) AS null_count
        FROM (SELECT ticker, unnest([{', '.join(parts)}]) AS x FROM {FEAT_ALL} GROUP BY ticker)"""


@register("feature_profile", "AG-19", _profile_sql())
def q_profile(spark, sf):
    f = feature_matrix(bars_from_lineitem(spark, sf), drop_incomplete=False)
    return M.feature_profile(f, FEATURE_COLUMNS)


@register("first_seen_types", "AG-24", """
    SELECT p_type, first_seen FROM (SELECT p_type, min(p_partkey) AS first_seen FROM part GROUP BY p_type)
    ORDER BY first_seen, p_type LIMIT 50""")
def q_first_seen(spark, sf):
    r = M.first_seen_values(read_table(spark, sf, "part"), "p_type", ["p_partkey"], 50)
    return r.select("p_type", F.col("first_seen.p_partkey").alias("first_seen"))


@register("correlation_complete_case", "AG-14", _corr_sql())
def q_corr_complete(spark, sf):
    return present(M.correlation_complete_case(features(spark, sf), _CORR_COLS))
