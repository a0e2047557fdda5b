"""Queries for supervised models (ML-01 … ML-08, ML-28).

Fitted models are memoised per (session, data folder) so that the scoring
queries reuse one fit; fits use the reference's hyper-parameters.
"""
from __future__ import annotations

from pyspark.sql import Window, functions as F

from tickwise.functions.exprs import present
from tickwise.operators import models as MD
from tickwise.plans.catalog import register
from tickwise.plans.q_timeseries import features
from tickwise.plans.sqlparts import features_sql
from tickwise.session import materialize

_FITS: dict = {}


def _feats(spark, sf):
    """The feature rows, stored once: a fit reads them hundreds of times, and each time would build the bars from the ticks again."""
    k = ("features", spark.sparkContext.applicationId, sf)
    if k not in _FITS:
        _FITS[k] = materialize(features(spark, sf))
    return _FITS[k]


def _regressor(spark, sf):
    k = ("reg", spark.sparkContext.applicationId, sf)
    if k not in _FITS:
        _FITS[k] = MD.train_regressor(_feats(spark, sf))
    return _FITS[k]


def _classifier(spark, sf):
    k = ("cls", spark.sparkContext.applicationId, sf)
    if k not in _FITS:
        _FITS[k] = MD.train_classifier(_feats(spark, sf))
    return _FITS[k]


LABEL_SQL = f"""(SELECT ticker, date, CAST((lead(Close) OVER w - Close) / Close > 0 AS INTEGER) AS label,
                        (lead(Close) OVER w - Close) / Close AS nx
                 FROM ({features_sql()}) WINDOW w AS (PARTITION BY ticker ORDER BY date))"""


@register("direction_labels", "ML-01, TS-14", f"SELECT ticker, date, label FROM {LABEL_SQL} WHERE nx IS NOT NULL")
def q_labels(spark, sf):
    d, _ = MD.label_direction(_feats(spark, sf))
    return d.select("ticker", "date", "label")


@register("direction_labels_fallback", "ML-01", f"""
    SELECT ticker, date, 'log_return' AS by, CAST(nx > 0 AS INTEGER) AS label FROM (
      SELECT ticker, date, lead(log_return) OVER (PARTITION BY ticker ORDER BY date) AS nx FROM ({features_sql()})) WHERE nx IS NOT NULL
    UNION ALL SELECT ticker, date, 'target', CAST(macd_hist > 0 AS INTEGER) FROM ({features_sql()})""")
def q_labels_fallback(spark, sf):
    """Without a close the next log return decides; a named column is taken as it stands."""
    f = _feats(spark, sf)
    one, _ = MD.label_direction(f.drop("Close"))
    two, _ = MD.label_direction(f, target_col="macd_hist")
    return one.select("ticker", "date", F.lit("log_return").alias("by"), "label").unionByName(two.select("ticker", "date", F.lit("target").alias("by"), "label"))


@register("stratified_split", "ML-02", f"""
    WITH l AS (SELECT * FROM {LABEL_SQL} WHERE nx IS NOT NULL),
    c AS (SELECT *, count(*) OVER (PARTITION BY ticker, label) AS ncls FROM l),
    t AS (SELECT *, min(ncls) OVER (PARTITION BY ticker) AS mn, count(*) OVER (PARTITION BY ticker) AS n,
                 count(DISTINCT label) OVER (PARTITION BY ticker) AS k FROM c)
    SELECT ticker, date, label,
           CASE WHEN k > 1 AND mn < 2
                THEN row_number() OVER (PARTITION BY ticker ORDER BY date) > greatest(floor(n * 0.8), 1)
                ELSE row_number() OVER (PARTITION BY ticker, label
                       ORDER BY md5(concat_ws('|', ticker, CAST(date AS VARCHAR), '42')), date)
                     <= ceil(ncls * 0.2) END AS is_val
    FROM t""")
def q_split(spark, sf):
    d, _ = MD.label_direction(_feats(spark, sf))
    return MD.stratified_split(d).select("ticker", "date", "label", "is_val")


@register("gbt_regressor_metrics", "ML-03, AG-01, TS-20")
def q_reg_metrics(spark, sf):
    _, _, metrics, _ = _regressor(spark, sf)
    return metrics


@register("gbt_batch_scores", "ML-05")
def q_reg_scores(spark, sf):
    model, feats, _, _ = _regressor(spark, sf)
    d, _ = MD.regression_frame(_feats(spark, sf))
    return MD.score_regression(model, d, feats).select("ticker", "date", "target", "prediction")


@register("gbt_classifier_metrics", "ML-04, AG-03, AG-04, AG-05")
def q_cls_metrics(spark, sf):
    _, _, metrics, _, _ = _classifier(spark, sf)
    return metrics


@register("gbt_class_scores", "ML-06")
def q_cls_scores(spark, sf):
    model, feats, _, _, _ = _classifier(spark, sf)
    d, _ = MD.label_direction(_feats(spark, sf))
    return MD.score_classification(model, d, feats).select("ticker", "date", "label", "proba_up", "pred_label")


@register("classifier_samples", "ML-02, ML-04", f"""
    WITH l AS (SELECT *, count(*) OVER (PARTITION BY ticker, label) AS ncls FROM {LABEL_SQL} WHERE nx IS NOT NULL)
    SELECT ticker, 'ok' AS status, count(*) AS n_rows, CAST(count(*) - sum(ceil(ncls * 0.2) / ncls) AS BIGINT) AS n_train,
           CAST(sum(ceil(ncls * 0.2) / ncls) AS BIGINT) AS n_val, true AS has_losses FROM (
      SELECT ticker, label, ncls, count(*) OVER (PARTITION BY ticker) AS n FROM l) GROUP BY ticker""")
def q_cls_samples(spark, sf):
    _, _, metrics, _, _ = _classifier(spark, sf)
    finite = (F.col("logloss_train") > 0) & (F.col("logloss_val") > 0) & F.col("brier").between(0, 1)
    return metrics.select("ticker", "status", "n_rows", "n_train", "n_val", finite.alias("has_losses"))


_COMPLETE_SQL = f"""(SELECT ticker, date, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn, count(*) OVER (PARTITION BY ticker) AS n
    FROM (SELECT ticker, date, lead("return") OVER (PARTITION BY ticker ORDER BY date) AS target FROM ({features_sql()})) WHERE target IS NOT NULL)"""


@register("regressor_samples", "ML-03, TS-20", f"""
    SELECT ticker, count(*) AS n_test, true AS mae_below_rmse FROM {_COMPLETE_SQL} WHERE rn > floor(n * 0.8) GROUP BY ticker""")
def q_reg_samples(spark, sf):
    _, _, metrics, _ = _regressor(spark, sf)
    return metrics.select("ticker", F.col("n").alias("n_test"), ((F.col("mae") <= F.col("rmse")) & (F.col("rmse") > 0)).alias("mae_below_rmse"))


@register("model_score_checks", "ML-05, ML-06", f"""
    SELECT ticker, c.n AS n_regression, l.n AS n_classified, true AS all_scored, true AS labels_follow FROM
    (SELECT ticker, count(*) AS n FROM {_COMPLETE_SQL} GROUP BY ticker) c JOIN (SELECT ticker, count(*) AS n FROM {LABEL_SQL} WHERE nx IS NOT NULL GROUP BY ticker) l USING (ticker)""")
def q_score_checks(spark, sf):
    """A score for every row, and labels that follow from the probability."""
    reg = q_reg_scores(spark, sf).groupBy("ticker").agg(F.count(F.lit(1)).alias("n_regression"), F.bool_and(F.abs("prediction") < float("inf")).alias("scored"))
    p = F.col("proba_up")
    cls = q_cls_scores(spark, sf).groupBy("ticker").agg(F.count(F.lit(1)).alias("n_classified"), F.bool_and((p > 0) & (p < 1)).alias("inside"),
                                                       F.bool_and((p >= 0.5) == (F.col("pred_label") == 1)).alias("labels_follow"))
    return reg.join(cls, "ticker").select("ticker", "n_regression", "n_classified", (F.col("scored") & F.col("inside")).alias("all_scored"), "labels_follow")


_FRIDAY = "(CASE dayofweek(last_date) WHEN 6 THEN last_date - 1 WHEN 0 THEN last_date - 2 ELSE last_date END)"


@register("multi_day_calendar", "ML-07, ML-08, TS-18, PRJ-12", f"""
    SELECT ticker, last_date AS source_date, 'ok' AS status, CAST(step AS BIGINT) AS step,
           {_FRIDAY} + CAST(step + 2 * floor(((dayofweek({_FRIDAY}) + 6) % 7 + step) / 5) AS INTEGER) AS pred_date, true AS compounds
    FROM (SELECT ticker, max(date) AS last_date, unnest(range(1, 8)) AS step FROM ({features_sql()}) GROUP BY ticker)""")
def q_multi_day_calendar(spark, sf):
    """Each forecast day is a business day after the latest row's, and its close is the one before times the predicted return."""
    model, feats, _, _ = _regressor(spark, sf)
    f = _feats(spark, sf)
    start = MD.predict_next(model, f, feats).select("ticker", "source_date", "status", "predicted_return")
    closes = f.groupBy("ticker").agg(F.max_by("Close", "date").alias("last_close"))
    path = MD.forecast_next_days(model, f, feats, 7)
    before = F.coalesce(F.lag("predicted_close").over(Window.partitionBy("ticker").orderBy("step")), F.col("last_close"))
    path = path.join(closes, "ticker").withColumn("compounds", F.abs(F.col("predicted_close") - before * (1 + F.col("predicted_return"))) <= 1e-9 * F.abs("predicted_close"))
    return path.join(start.drop("predicted_return"), "ticker").select("ticker", "source_date", "status", F.col("step").cast("bigint").alias("step"), "pred_date", "compounds")


@register("next_day_prediction", "ML-07, PRJ-12")
def q_next_day(spark, sf):
    model, feats, _, _ = _regressor(spark, sf)
    return MD.predict_next(model, _feats(spark, sf), feats)


@register("multi_day_forecast", "ML-08, TS-18, SCL-06")
def q_multi_day(spark, sf):
    model, feats, _, _ = _regressor(spark, sf)
    return MD.forecast_next_days(model, _feats(spark, sf), feats, 7)


@register("reliability_report", "ML-28, AG-05, AG-06, AG-08")
def q_reliability(spark, sf):
    model, feats, _, _, _ = _classifier(spark, sf)
    d, _ = MD.label_direction(_feats(spark, sf))
    s = MD.score_classification(model, d, feats)
    return present(MD.reliability_report(s, "label", "proba_up"))
