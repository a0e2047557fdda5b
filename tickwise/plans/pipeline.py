"""ML-29: the whole flow as one Spark application.

bars → features (written once, read back: lineage cut, executor loss only
re-reads files) → regressor → classifier → rules → next-day → clusters →
PCA → forecast → checks, every output stored in the run registry under a
shared root with one UTC run stamp.  Steps can be chosen; a run that skips
a step simply lacks that artifact kind (the registry falls back to older
runs, REG-02).
"""
from __future__ import annotations

import os
import sys

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickwise.operators import checks as C
from tickwise.operators import cluster as CL
from tickwise.operators import forecast as FC
from tickwise.operators import models as MD
from tickwise.operators import pca as PC
from tickwise.operators import rules as RU
from tickwise.operators.boosting import StagewiseClassifier
from tickwise.operators.timeseries import FEATURE_COLUMNS, feature_matrix
from tickwise.sources import registry as REG
from tickwise.sources.bars import bars_from_lineitem
from tickwise.session import get_session, materialize
from tickwise.sources.sinks import check_report, run_stamp, write_partitioned

ALL_STEPS = ["regressor", "classifier", "association", "next_day", "clusters", "pca", "forecast", "checks"]
PCA_COLS = [c for c in FEATURE_COLUMNS if c != "date"]


def stored_gates(spark: SparkSession, feats: DataFrame, root: str, expected: DataFrame, own_run: str | None = None) -> list[DataFrame]:
    """DQ-07 … DQ-09: the latest stored models score the features they name; what is missing is a warning."""
    reg = REG.read_registry(spark, root, own_run)
    out = []
    for kind in ("regressor", "classifier"):
        meta = materialize(REG.latest_with_kind(reg, kind))
        out.append(C.missing_artifacts(kind, expected, meta))
        newest = meta.agg(F.max("run_ts")).first()[0]
        if newest is None:
            continue
        path = os.path.join(root, "models", newest, kind)
        names = [r.feature for r in REG.expected_features(reg.where(F.col("run_ts") == newest), kind).select("pos", "feature").distinct().orderBy("pos").collect()]
        count = meta.select("ticker", F.json_array_length(F.get_json_object("payload", "$.features")).alias("n_expected"))
        out.append(C.feature_count_check(count, len([n for n in names if n in feats.columns])))
        if kind == "regressor":
            rows, _ = MD.regression_frame(feats)
            scored = MD.score_regression(GBTRegressionModel.load(path), rows, names)
            rmse = meta.select("ticker", F.get_json_object("payload", "$.metrics.rmse").cast("double").alias("rmse"))
            out.append(C.regressor_gate(scored, "target", "prediction", rmse))
        else:
            rows, _ = MD.label_direction(feats)
            out.append(C.classifier_gate(MD.score_classification(StagewiseClassifier.load(path), rows, names), "label", "proba_up"))
    return out


def run_pipeline(spark: SparkSession, sf_dir: str, root: str, key: str = "l_returnflag",
                 steps=None, run_ts: str | None = None, reg_params: dict | None = None,
                 cls_params: dict | None = None) -> str:
    steps = list(steps or ALL_STEPS)
    run_ts = run_ts or run_stamp()
    REG.open_run(spark, root)
    write_partitioned(bars_from_lineitem(spark, sf_dir, key), os.path.join(root, "bars"))  # SRC-07
    bars = spark.read.parquet(os.path.join(root, "bars"))
    write_partitioned(feature_matrix(bars),
                      os.path.join(root, "features"))                          # SRC-08
    feats = spark.read.parquet(os.path.join(root, "features"))

    if "regressor" in steps or "next_day" in steps:
        model, names, metrics, _ = MD.train_regressor(feats, reg_params)
        model.write().overwrite().save(os.path.join(root, "models", run_ts, "regressor"))
        meta = metrics.select("ticker", F.lit("gbt-regressor").alias("name"),
                              F.array(*[F.lit(n) for n in names]).alias("features"),
                              F.struct("rmse", "mae").alias("metrics"))
        REG.write_artifact(meta, root, "regressor", run_ts)
        if "next_day" in steps:
            nd = MD.predict_next(model, feats, names).withColumn("run_ts", F.lit(run_ts))
            write_partitioned(nd, os.path.join(root, "next_day"), ("run_ts",))
    if "classifier" in steps:
        model, names, metrics, calib, _ = MD.train_classifier(feats, cls_params)
        model.save(os.path.join(root, "models", run_ts, "classifier"))
        cal = calib.groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct("bin", "prob_true", "prob_pred")))
                                          .alias("calibration"))
        meta = metrics.where("status = 'ok'").join(cal, "ticker", "left").select(
            "ticker", F.lit("classification").alias("task"), F.array(*[F.lit(n) for n in names]).alias("features"),
            F.struct("logloss_train", "auc_train", "logloss_val", "auc_val").alias("metrics"),
            F.struct("brier", "calibration").alias("calibration"),
            F.struct((F.col("n_train") + F.col("n_val")).alias("total"), F.col("n_train").alias("train"),
                     F.col("n_val").alias("val")).alias("samples"))
        REG.write_artifact(meta, root, "classifier", run_ts)
    if "association" in steps:
        rules = RU.mine_rules(feats, 0.05, 0.5, 200)
        meta = rules.groupBy("ticker").agg(
            F.count(F.lit(1)).alias("n_rules"),
            F.sort_array(F.collect_list(F.struct("rank", "antecedents", "consequents", "support", "confidence",
                                                 "lift", "leverage", "conviction"))).alias("rules"))
        REG.write_artifact(meta.select("ticker", F.lit(0.05).alias("min_support"), F.lit(0.5).alias("min_confidence"),
                                       "n_rules", "rules"), root, "association", run_ts)
    if "clusters" in steps:
        x = PC.pca_inputs(feats, PCA_COLS, log_cols=())
        zx = PC.standardize_by_window(x, PCA_COLS)
        stats = zx.groupBy("ticker").agg(F.first("mean").alias("mean"), F.first("scale").alias("scale"))
        z = zx.drop("mean", "scale", "const")
        labels, centers, summary = CL.kmeans(z, PCA_COLS, k=5, seed=42)
        meta = summary.join(centers, "ticker").join(stats.select("ticker", "mean", "scale"), "ticker").select(
            "ticker", F.lit(5).alias("n_clusters"), "inertia", "centers",
            F.array(*[F.lit(c) for c in PCA_COLS]).alias("feature_order"), "sizes",
            F.col("mean").alias("scaler_mean"), F.col("scale").alias("scaler_scale"))
        REG.write_artifact(meta, root, "clusters", run_ts)
        write_partitioned(labels.withColumn("run_ts", F.lit(run_ts)), os.path.join(root, "cluster_labels"),
                          ("ticker", "run_ts"))                                   # SRC-15
    if "pca" in steps:
        meta, z = PC.fit_pca(feats, PCA_COLS, 5)
        meta = meta.checkpoint()
        REG.write_artifact(meta, root, "pca", run_ts)
        scores = PC.pca_scores(z, meta, PCA_COLS).withColumn("run_ts", F.lit(run_ts))
        write_partitioned(scores, os.path.join(root, "pca_scores"), ("ticker", "run_ts"))
    if "forecast" in steps:
        fit = FC.fit_arima(feats)
        fc = FC.forecast(fit, 7)
        meta = fit.join(fc.groupBy("ticker").agg(
            F.sort_array(F.collect_list(F.struct("step", "date", "prediction", "lower", "upper"))).alias("f")),
            "ticker").select("ticker", F.lit(7).alias("horizon"), F.array(F.lit(1), F.lit(1), F.lit(1)).alias("order"),
                             "aic", "bic", "log_likelihood", "rmse", "mae", F.col("last_obs").alias("last_observation"),
                             F.transform("f", lambda s: s["prediction"]).alias("predictions"),
                             F.transform("f", lambda s: F.date_format(s["date"], "yyyy-MM-dd")).alias("dates"),
                             F.transform("f", lambda s: F.array(s["lower"], s["upper"])).alias("confidence_interval"))
        REG.write_artifact(meta, root, "forecast", run_ts)
        write_partitioned(fc.withColumn("run_ts", F.lit(run_ts)), os.path.join(root, "forecasts"), ("run_ts",))
    if "checks" in steps:
        num = [c for c in FEATURE_COLUMNS if c != "date"]
        stored, fresh = REG.init_or_read_baseline(feats, os.path.join(root, "baseline"))
        expected = materialize(bars.select("ticker").distinct())
        gates = stored_gates(spark, feats, root, expected, run_ts) if {"regressor", "classifier"} & set(steps) else []
        rep = check_report(C.check_run(feats, num, stored, fresh, expected=expected, gates=gates))
        rep.write.mode("overwrite").json(os.path.join(root, "reports", run_ts))   # SRC-17
    REG.publish_run(spark, root, run_ts, [k for k in REG.MODEL_KINDS if k in steps])
    return run_ts


def main(argv: list[str]) -> int:
    """A job of all steps: ``pipeline <tables> <root> [--no-gate]``; ends with DQ-10's exit code."""
    sf_dir, root = argv[:2]
    spark = get_session()
    run_ts = run_pipeline(spark, sf_dir, root)
    status = spark.read.json(os.path.join(root, "reports", run_ts)).select("ticker", "overall_status")
    return C.exit_code(status, gate="--no-gate" not in argv)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
