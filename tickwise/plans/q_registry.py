"""Queries over a registry that the pipeline writes from the
given tables (two runs with different step sets plus the stored matrices).
The registry is built once per session and data folder."""
from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tickwise.operators.timeseries import FEATURE_COLUMNS
from tickwise.plans.catalog import register
from tickwise.plans.pipeline import run_pipeline
from tickwise.plans.q_models import LABEL_SQL
from tickwise.plans.sqlparts import features_sql
from tickwise.session import scratch_path
from tickwise.sources import registry as REG
from tickwise.sources.bars import bars_sql

_ROOTS: dict = {}


def registry_root(spark, sf):
    k = (spark.sparkContext.applicationId, sf)
    if k not in _ROOTS:
        root = scratch_path(spark, f"registry-{uuid.uuid4().hex[:8]}")
        # an older run with all eight steps (few trees), a newer one with rules only
        run_pipeline(spark, sf, root, run_ts="20240101000000", reg_params=dict(maxIter=5, maxDepth=3, stepSize=0.1, seed=42),
                     cls_params=dict(rounds=3, depth=3, patience=3))
        run_pipeline(spark, sf, root, steps=["association"], run_ts="20240201000000")
        # a third run that broke off after one kind, and an artifact that belongs to no run
        rules = REG.latest_with_kind(REG.read_registry(spark, root), "association").select("ticker", F.lit(0).alias("n_rules"))
        REG.write_artifact(rules, root, "association", "20240301000000")
        REG.write_artifact(rules.where("ticker = 'A'"), root, "forecast", "")
        _ROOTS[k] = root
    return _ROOTS[k]


def _reg(spark, sf):
    return REG.read_registry(spark, registry_root(spark, sf))


_TICKERS = f"(SELECT DISTINCT ticker FROM ({features_sql()}))"


@register("registry_latest_run", "REG-01, SRC-18, ML-29", f"SELECT ticker, '20240201000000' AS run_ts FROM {_TICKERS}")
def q_latest_run(spark, sf):
    return REG.latest_run(_reg(spark, sf))


@register("registry_latest_with_kind", "REG-02", f"""
    SELECT ticker, '20240101000000' AS run_ts, 'pca_' || ticker AS name FROM {_TICKERS}""")
def q_latest_kind(spark, sf):
    return REG.latest_with_kind(_reg(spark, sf), "pca").select("ticker", "run_ts", "name")


@register("registry_newest_or_flat", "REG-03", f"""
    SELECT ticker, CASE WHEN ticker = 'A' THEN '' END AS run_ts, CASE WHEN ticker = 'A' THEN 'forecast_A' END AS name FROM {_TICKERS}""")
def q_newest_or_flat(spark, sf):
    return REG.newest_or_flat(_reg(spark, sf), "forecast").select("ticker", "run_ts", "name")


@register("registry_inventory", "REG-05, SCL-04")
def q_inventory(spark, sf):
    return REG.inventory(spark, registry_root(spark, sf)).select("name", "kind", "size", "size_human")


@register("registry_artifact_detail", "REG-06, SRC-14", f"""
    SELECT ticker, run_ts, kind, kind || '_' || ticker AS name, CAST(CASE kind WHEN 'regressor' THEN {len(FEATURE_COLUMNS) - 2} WHEN 'classifier' THEN {len(FEATURE_COLUMNS) - 3}
           WHEN 'pca' THEN 27 WHEN 'clusters' THEN 27 END AS BIGINT) AS n_items, CAST(CASE kind WHEN 'regressor' THEN 3 WHEN 'association' THEN 4 ELSE 5 END AS BIGINT) AS n_keys
    FROM {_TICKERS} CROSS JOIN (VALUES ('20240101000000', 'regressor'), ('20240101000000', 'classifier'), ('20240101000000', 'association'), ('20240101000000', 'clusters'),
        ('20240101000000', 'pca'), ('20240101000000', 'forecast'), ('20240201000000', 'association')) m(run_ts, kind)""")
def q_detail(spark, sf):
    d = REG.artifact_detail(_reg(spark, sf)).where("run_ts <> ''")
    return d.select("ticker", "run_ts", "kind", "name", F.col("n_items").cast("bigint").alias("n_items"), F.size("first_keys").cast("bigint").alias("n_keys"))


@register("registry_array_summary", "REG-07, SRC-15", f"""
    SELECT ticker, count(*) AS n_rows, CAST(5 AS BIGINT) AS n_cols, 'double' AS dtype, true AS ordered FROM ({features_sql()}) GROUP BY ticker""")
def q_array_summary(spark, sf):
    m = spark.read.parquet(os.path.join(registry_root(spark, sf), "pca_scores"))
    return REG.array_summary(m, "pc").select("ticker", "n_rows", F.col("n_cols").cast("bigint").alias("n_cols"), "dtype", (F.col("min") < F.col("max")).alias("ordered"))


@register("registry_run_summary", "REG-08", f"""
    SELECT ticker, run_ts, run_ts < '202402' AS has_regressor, run_ts < '202402' AS has_classifier, run_ts < '202402' AS has_clusters,
           run_ts < '202402' AS has_pca, run_ts < '202402' AS has_forecast, true AS has_association
    FROM {_TICKERS} CROSS JOIN (VALUES ('20240101000000'), ('20240201000000')) r(run_ts)""")
def q_run_summary(spark, sf):
    return REG.run_summary(_reg(spark, sf))


_REG_FEATURES = [c for c in FEATURE_COLUMNS if c not in ("date", "return")]
_CLS_FEATURES = [c for c in _REG_FEATURES if c != "log_return"]
_LINES = {"association": "rules", "classifier": f"features={len(_CLS_FEATURES)}", "clusters": "centers=5", "forecast": "forecast", "pca": "components=5",
          "regressor": f"features={len(_REG_FEATURES)}"}
_RUNS_SQL = f"""(SELECT ticker, run_ts, kind, info FROM {_TICKERS} CROSS JOIN (VALUES {', '.join(f"('20240101000000', '{k}', '{v}')" for k, v in _LINES.items())},
        ('20240201000000', 'association', 'rules')) m(run_ts, kind, info))"""


@register("registry_model_lines", "REG-08, ML-29", f"SELECT ticker, run_ts, kind, kind || '_' || ticker AS name, info FROM {_RUNS_SQL}")
def q_model_lines(spark, sf):
    return REG.model_lines(_reg(spark, sf))


@register("registry_overview", "REG-09, ML-29", f"""
    SELECT ticker, CAST(row_number() OVER (PARTITION BY ticker ORDER BY run_ts) AS BIGINT) AS position, run_ts, artifacts, models FROM (
      SELECT ticker, run_ts, string_agg(kind || '_' || ticker, ' ' ORDER BY kind) AS artifacts, string_agg(kind || ': ' || info, ', ' ORDER BY kind) AS models
      FROM {_RUNS_SQL} GROUP BY ticker, run_ts)""")
def q_overview(spark, sf):
    runs = REG.overview(_reg(spark, sf)).select("ticker", F.posexplode("runs").alias("position", "r"))
    return runs.select("ticker", (F.col("position") + 1).cast("bigint").alias("position"), "r.run_ts", F.array_join("r.artifacts", " ").alias("artifacts"),
                       F.array_join(F.transform("r.models", lambda m: F.concat(m["kind"], F.lit(": "), m["info"])), ", ").alias("models"))


@register("registry_read_back", "REG-12", f"""
    SELECT ticker, '20240101000000' AS run_ts, '2024-01-01 00:00:00' AS last_run, 'pca_' || ticker AS name, CAST(27 AS BIGINT) AS n_features,
           '{' '.join(c for c in FEATURE_COLUMNS if c != 'date')}' AS feature_names FROM {_TICKERS}""")
def q_read_back(spark, sf):
    r = REG.read_back(_reg(spark, sf), "pca")
    return r.select("ticker", "run_ts", F.date_format("last_run", "yyyy-MM-dd HH:mm:ss").alias("last_run"), "name",
                    F.col("n_features").cast("bigint").alias("n_features"), F.array_join("feature_names", " ").alias("feature_names"))


@register("registry_expected_features", "REG-10", f"""
    SELECT ticker, '20240101000000' AS run_ts, CAST(pos AS BIGINT) AS pos, feature FROM {_TICKERS} CROSS JOIN
    (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(_REG_FEATURES))}) f(pos, feature)""")
def q_expected_features(spark, sf):
    return REG.expected_features(_reg(spark, sf), "regressor").withColumn("pos", F.col("pos").cast("bigint"))


@register("registry_forecast_doc", "SRC-14, REG-11")
def q_forecast_doc(spark, sf):
    r = REG.latest_with_kind(_reg(spark, sf), "forecast")
    schema = "horizon int, aic double, bic double, predictions array<double>, dates array<string>"
    return r.select("ticker", "run_ts", F.from_json("payload", schema).alias("f")).select("ticker", "run_ts", "f.*")


@register("registry_latest_prediction", "REG-04")
def q_latest_prediction(spark, sf):
    p = spark.read.parquet(os.path.join(registry_root(spark, sf), "forecasts")).withColumn(
        "run_ts", F.col("run_ts").cast("string"))
    first = p.where(F.col("step") == 1)
    return REG.latest_prediction(first).select("ticker", "run_ts", "date", "prediction")


@register("pipeline_bars_table", "SRC-07, ML-29", f"""
    SELECT ticker, count(*) AS n_bars, min(date) AS first_date, max(date) AS last_date
    FROM ({bars_sql("l_returnflag")}) GROUP BY ticker""")
def q_bars_table(spark, sf):
    return spark.read.parquet(os.path.join(registry_root(spark, sf), "bars")).groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_bars"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@register("pipeline_features_table", "SRC-08, SRC-02", f"""
    SELECT ticker, count(*) AS n_rows, CAST(29 AS INTEGER) AS n_cols FROM ({features_sql()}) GROUP BY ticker""")
def q_features_table(spark, sf):
    f = spark.read.parquet(os.path.join(registry_root(spark, sf), "features"))
    return f.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(f.columns)).alias("n_cols"))


@register("check_report_docs", "SRC-17, DQ-07, DQ-08, DQ-09, DQ-10, ML-29", f"""
    SELECT ticker, 'baseline_initialized classifier_performance duplicate_rows feature_count file_non_empty missingness regressor_performance' AS checks,
           true AS has_status, true AS has_markdown FROM {_TICKERS}""")
def q_check_report(spark, sf):
    r = spark.read.json(os.path.join(registry_root(spark, sf), "reports", "20240101000000"))
    names = F.array_join(F.array_sort(F.array_distinct(F.from_json(F.get_json_object("json", "$.checks[*].name"), "array<string>"))), " ")
    return r.select("ticker", names.alias("checks"), F.col("overall_status").isin("ok", "warning", "severe").alias("has_status"), (F.length("markdown") > 0).alias("has_markdown"))


@register("labelled_dataset_csv", "SRC-01, SRC-12, SRC-13", f"""
    SELECT ticker, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_up FROM {LABEL_SQL} WHERE nx IS NOT NULL GROUP BY ticker""")
def q_labelled_csv(spark, sf):
    from tickwise.operators.models import label_direction
    from tickwise.sources.sinks import run_stamp, write_csv
    from tickwise.sources.tables import load_frame
    root = registry_root(spark, sf)
    lab, _ = label_direction(spark.read.parquet(os.path.join(root, "features")))
    lab = lab.select("ticker", "date", "Close", "rsi_14", "label")
    path = os.path.join(root, "labelled", f"{run_stamp()}.csv")
    write_csv(lab, path)
    back = load_frame(spark, path)
    return back.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("n_up"))


@register("feature_count_check", "DQ-09, REG-10", f"""
    SELECT ticker, name, severity, value FROM {_TICKERS} CROSS JOIN (VALUES ('classifier_features', 'ok', {len(FEATURE_COLUMNS) - 3}.0::DOUBLE),
        ('regressor_features', 'ok', {len(FEATURE_COLUMNS) - 2}.0::DOUBLE), ('short_frame', 'warning', {len(FEATURE_COLUMNS) - 2}.0::DOUBLE)) c(name, severity, value)""")
def q_feature_count(spark, sf):
    """What the stored models expect against the stored feature table, and against one that lacks a column."""
    from tickwise.operators import checks as C
    reg, feats = _reg(spark, sf), spark.read.parquet(os.path.join(registry_root(spark, sf), "features"))

    def check(kind, columns, name):
        want = REG.expected_features(reg, kind)
        n = want.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_expected"))
        have = len([r.feature for r in want.select("feature").distinct().collect() if r.feature in columns])
        return C.feature_count_check(n, have).select("ticker", F.lit(name).alias("name"), "severity", F.col("value").cast("double").alias("value"))

    return C.union_checks(check("classifier", feats.columns, "classifier_features"), check("regressor", feats.columns, "regressor_features"),
                          check("regressor", [c for c in feats.columns if c != "rsi_14"], "short_frame"))
