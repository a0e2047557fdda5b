"""Supervised models (ML-01 … ML-08, ML-28) with Spark ML.

Scale choice: one *pooled* model over all tickers (Spark ML trains it
distributed); metrics are reported per ticker.  Splits are per ticker.
The regressor is Spark's GBT (first-order boosting, no L2 term, per-node column
sampling), the classifier boosts Spark ML trees stage by stage with Newton
targets and columns drawn per tree (``boosting``); quality is comparable in
band, not in digits.
"""
from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window, functions as F

from tickwise.operators import metrics as M
from tickwise.operators.boosting import StagewiseClassifier, boost
from tickwise.operators.projections import complete_cases, finite_only, impute, latest_row, numeric_columns
from tickwise.operators.timeseries import add_business_days, by_date, chronological_split
from tickwise.session import materialize

# The reference's hyper-parameters, and its patience: rounds without a better validation loss.
REGRESSOR_PARAMS = dict(maxIter=300, maxDepth=4, stepSize=0.05, subsamplingRate=0.8,
                        featureSubsetStrategy="0.8", seed=42)
CLASSIFIER_PARAMS = dict(rounds=200, depth=5, step=0.1, subsample=0.8, columns=0.8, patience=10, seed=42)


def regression_frame(features: DataFrame, part: str = "ticker") -> tuple[DataFrame, list[str]]:
    """Target = next row's return (TS-13); X = numeric columns minus date,
    ticker, return (PRJ-01); complete cases only (PRJ-04); chronological
    80 / 20 split per ticker (TS-20)."""
    feats = numeric_columns(features, ("date", part, "return"))
    d = features.withColumn("target", F.lead("return").over(by_date(part)))
    d = complete_cases(d, feats + ["target"])
    return chronological_split(d, 0.8, part), feats


def train_regressor(features: DataFrame, params: dict | None = None, part: str = "ticker"):
    """ML-03: pooled GBT regressor; returns (model, feature names, per-ticker
    test metrics, test predictions)."""
    d, feats = regression_frame(features, part)
    va = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="skip")
    d = va.transform(d)
    gbt = GBTRegressor(labelCol="target", featuresCol="features", **(params or REGRESSOR_PARAMS))
    model = gbt.fit(d.where("is_train"))
    pred = model.transform(d.where(~F.col("is_train")))
    metrics = M.regression_metrics(pred, "target", "prediction", [part])
    return model, feats, metrics, pred.drop("features")


def label_direction(features: DataFrame, part: str = "ticker", target_col: str | None = None) -> tuple[DataFrame, list[str]]:
    """ML-01: y = given return > 0: the column ``target_col`` as it stands if
    there is one, else the next close return, else (no Close) the next row's
    log_return; rows without it go.  return and log_return leave X; non-finite
    → NULL, then imputed (PRJ-02, PRJ-07)."""
    w = by_date(part)
    if target_col is not None and target_col in features.columns:
        ret = F.col(target_col).cast("double")
    elif "Close" in features.columns:
        ret = F.try_divide(F.lead("Close").over(w) - F.col("Close"), F.col("Close"))
    elif "log_return" in features.columns:
        ret = F.lead("log_return").over(w)
    else:
        raise ValueError("no Close, log_return or target column to label by")
    d = features.withColumn("_next", ret).where(F.col("_next").isNotNull() & ~F.isnan("_next"))
    d = d.withColumn("label", (F.col("_next") > 0).cast("int")).drop("_next")
    feats = numeric_columns(d, ("date", part, "return", "log_return", "label"))
    d = finite_only(d, feats)
    d = impute(d, feats, part)
    return d, feats


def stratified_split(df: DataFrame, label: str = "label", frac: float = 0.2, seed: int = 42,
                     part: str = "ticker", flag: str = "is_val") -> DataFrame:
    """ML-02: deterministic stratified split — inside each (ticker, label)
    the rows ranked first by ``md5(ticker|date|seed)`` (``ceil(frac·n)`` of
    them) are validation rows.  Same rows in any engine with md5.  When a
    ticker has two classes and one of them has a single row (stratification
    impossible) the ticker falls back to a contiguous split: the first
    ``max(int((1-frac)·n), 1)`` rows by date train, the rest validate."""
    key = F.md5(F.concat_ws("|", F.col(part).cast("string"), F.col("date").cast("string"), F.lit(str(seed))))
    w = Window.partitionBy(part, label).orderBy(key, "date")
    n_cls = F.count(F.lit(1)).over(Window.partitionBy(part, label))
    d = df.withColumn("_ncls", n_cls)
    wt = Window.partitionBy(part)
    d = d.withColumn("_min", F.min("_ncls").over(wt)).withColumn("_n", F.count(F.lit(1)).over(wt)) \
         .withColumn("_k", F.size(F.collect_set(label).over(wt)))
    strat = F.row_number().over(w) <= F.ceil(F.col("_ncls") * frac)
    cut = F.greatest(F.floor(F.col("_n") * (1.0 - frac)), F.lit(1))
    contiguous = F.row_number().over(Window.partitionBy(part).orderBy("date")) > cut
    fallback = (F.col("_k") > 1) & (F.col("_min") < 2)
    return d.withColumn(flag, F.when(fallback, contiguous).otherwise(strat)).drop("_ncls", "_min", "_n", "_k")


def train_classifier(features: DataFrame, params: dict | None = None, part: str = "ticker",
                     min_rows: int = 30):
    """ML-04: pooled stage-wise classifier stopped once the validation loss rests; per
    ticker train/validation log loss and AUC, Brier score and calibration.
    Tickers with fewer than ``min_rows`` labelled rows aren't trained on: their
    metrics row has the status ``skipped`` and only their number of rows."""
    d, feats = label_direction(features, part)
    sizes = d.groupBy(part).agg(F.count(F.lit(1)).alias("n_rows"))
    small = F.col("n_rows") < min_rows
    d = stratified_split(d.join(sizes.where(~small).select(part), part), "label", 0.2, 42, part)
    va = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
    d = materialize(va.transform(d))
    model = boost(d, len(feats), **(params or CLASSIFIER_PARAMS), key=(part, "date"))
    scored = model.score(d)
    def side(flag):
        s = scored.where(F.col("is_val") == flag)
        m = M.classification_metrics(s, "label", "p", [part])
        a = M.roc_auc(s, "label", "p", [part]).select(part, "auc")
        return m.join(a, part, "left")
    tr, va_ = side(False), side(True)
    metrics = (tr.select(part, F.col("logloss").alias("logloss_train"), F.col("auc").alias("auc_train"),
                         F.col("n").alias("n_train"))
               .join(va_.select(part, F.col("logloss").alias("logloss_val"), F.col("auc").alias("auc_val"),
                                F.col("brier").alias("brier"), F.col("n").alias("n_val")), part, "left"))
    skipped = sizes.where(small).select(part, "n_rows", F.lit("skipped").alias("status"))
    metrics = metrics.join(sizes, part).withColumn("status", F.lit("ok")).unionByName(skipped, allowMissingColumns=True)
    calib = M.calibration_curve(scored.where("is_val"), "label", "p", [part])
    return model, feats, metrics, calib, scored.drop("features")


def score_regression(model, df: DataFrame, feats: list[str]) -> DataFrame:
    """ML-05: a prediction for every row; a missing value takes the right branch of its splits."""
    va = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
    return model.transform(va.transform(df)).drop("features")


def score_classification(model: StagewiseClassifier, df: DataFrame, feats: list[str], threshold: float = 0.5) -> DataFrame:
    """ML-06: probability of up and label = p ≥ threshold."""
    va = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
    s = model.score(va.transform(df), "proba_up")
    return s.withColumn("pred_label", (F.col("proba_up") >= threshold).cast("int")).drop("features")


def predict_next(model, features: DataFrame, feats: list[str], part: str = "ticker") -> DataFrame:
    """ML-07: next-day return from each ticker's latest row; a ticker whose
    latest row misses a feature has the status ``skipped`` and no prediction."""
    out = score_regression(model, latest_row(features, part), feats)
    whole = F.lit(True)
    for f in feats:
        whole = whole & F.col(f).isNotNull()
    return out.select(part, F.col("date").alias("source_date"), F.when(whole, F.col("prediction")).alias("predicted_return"),
                      F.array(*[F.col(f) for f in feats]).alias("values"), F.when(whole, "ok").otherwise("skipped").alias("status"))


def forecast_next_days(model, features: DataFrame, feats: list[str], days: int = 7,
                       part: str = "ticker", checkpoint_every: int = 5) -> DataFrame:
    """ML-08: recursive multi-day return forecast, all tickers in parallel.

    State per ticker: the latest feature row, closes and returns (newest
    first, ``max_needed`` long).  Each step rebuilds lag_close_k (=
    closes[k-1]), lag_return_k, SMA ``(old·(w−1)+c)/w``, EMA ``α c + (1−α) old``
    and vol_10 (population std of the last 10 returns); other features are
    carried.  The predicted return updates the state.  The predictions so far
    ride in the state row, and that one table is checkpointed every few steps.
    """
    days = max(1, min(90, int(days)))
    import re
    need = 1
    for f in feats:
        for pat in (r"lag_close_(\d+)$", r"lag_return_(\d+)$", r"sma_(\d+)$", r"ema_(\d+)$"):
            m = re.match(pat, f)
            if m:
                need = max(need, int(m.group(1)))
    if "vol_10" in feats:
        need = max(need, 10)
    w = Window.partitionBy(part).orderBy(F.col("date").desc())
    hist = features.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= need)
    arrs = hist.groupBy(part).agg(
        F.sort_array(F.collect_list(F.struct(F.col("_r"), F.col("Close")))).alias("_c"),
        F.sort_array(F.collect_list(F.struct(F.col("_r"), F.col("return")))).alias("_t"))
    pad = lambda a: F.concat(a, F.array_repeat(F.lit(0.0), F.greatest(F.lit(need) - F.size(a), F.lit(0))))
    arrs = arrs.select(part, pad(F.transform("_c", lambda s: s["Close"])).alias("closes"),
                       pad(F.transform("_t", lambda s: F.coalesce(s["return"], F.lit(0.0)))).alias("returns"))
    last = latest_row(features, part).select(part, "date", *[F.col(f).cast("double").alias(f) for f in feats])
    path = "array<struct<step:int,pred_date:date,predicted_return:double,predicted_close:double>>"
    state = last.join(arrs, part).withColumn("path", F.array().cast(path))
    for step in range(1, days + 1):
        cur = F.element_at("closes", 1)
        cols = []
        for f in feats:
            m = re.match(r"(lag_close|lag_return|sma|ema)_(\d+)$", f)
            if m and m.group(1) == "lag_close":
                v = F.element_at("closes", int(m.group(2)))
            elif m and m.group(1) == "lag_return":
                v = F.element_at("returns", int(m.group(2)))
            elif m and m.group(1) == "sma":
                k = int(m.group(2))
                v = (F.coalesce(F.col(f), F.lit(0.0)) * (k - 1) + cur) / float(k)
            elif m and m.group(1) == "ema":
                a = 2.0 / (int(m.group(2)) + 1)
                v = F.lit(a) * cur + F.lit(1 - a) * F.coalesce(F.col(f), F.lit(0.0))
            elif f == "vol_10":
                r10 = F.slice("returns", 1, 10)
                mean = F.aggregate(r10, F.lit(0.0), lambda s, x: s + x) / F.size(r10)
                v = F.sqrt(F.aggregate(r10, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / F.size(r10))
            else:
                v = F.coalesce(F.col(f), F.lit(0.0))
            cols.append(v.alias(f))
        fv = state.select(part, "date", "closes", "returns", "path", *cols)
        pred = score_regression(model, fv, feats).withColumnRenamed("prediction", "_p")
        close = F.element_at("closes", 1) * (F.lit(1.0) + F.col("_p"))
        point = F.struct(F.lit(step).alias("step"), add_business_days(F.col("date"), F.lit(step)).alias("pred_date"),
                         F.col("_p").alias("predicted_return"), close.alias("predicted_close"))
        state = pred.select(part, "date", *feats, F.slice(F.concat(F.array(close), F.col("closes")), 1, need).alias("closes"),
                            F.slice(F.concat(F.array(F.col("_p")), F.col("returns")), 1, need).alias("returns"),
                            F.array_append("path", point).alias("path"))
        if step % checkpoint_every == 0:
            state = materialize(state)
    return state.select(part, F.inline("path"))


def reliability_report(scored: DataFrame, y: str = "label", p: str = "proba_up",
                       stored: DataFrame | None = None, part: str = "ticker") -> DataFrame:
    """ML-28: stored calibration when present, else computed from scores
    (AG-06), with Brier score (AG-05) and per-bin assessment (AG-08)."""
    calib = M.calibration_curve(scored, y, p, [part])
    brier = M.classification_metrics(scored, y, p, [part]).select(part, "brier")
    out = calib.join(brier, part, "left")
    if stored is not None:
        have = stored.select(part).distinct()
        out = stored.unionByName(out.join(have, part, "left_anti"), allowMissingColumns=True)
    return out.withColumn("assessment", M.assess_bin(F.col("prob_pred"), F.col("prob_true")))
