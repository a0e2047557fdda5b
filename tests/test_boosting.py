"""Stage-wise boosting: margins, patience, draws, storing; and the classifier's and regressor's rows for skipped tickers."""
import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tickwise.operators import boosting as BO
from tickwise.operators import models as MD
from tickwise.operators.timeseries import feature_matrix
from tickwise.sources.bars import bars_from_lineitem


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(3)
    x = r.normal(0, 1, (900, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + r.normal(0, 0.3, 900) > 0).astype(int)
    df = spark.createDataFrame([("t", i, int(y[i]), bool(i % 4 == 0), *map(float, x[i])) for i in range(900)],
                               "ticker string, date int, label int, is_val boolean, a double, b double, c double, d double")
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).cache()


def losses(model, rows):
    got = model.score(rows.where("is_val")).select("label", "p").collect()
    return float(np.mean([-math.log(r.p if r.label else 1 - r.p) for r in got]))


def test_margins_are_the_models_sum_and_the_loss_falls(rows, tmp_path):
    model = BO.boost(rows, 4, rounds=6, depth=3, step=0.3, patience=10)
    assert len(model.losses) == model.trees.getNumTrees == 6
    assert model.losses[-1] < model.losses[0] < math.log(2)
    # the carried margins and the model that sums the trees give one loss
    assert losses(model, rows) == pytest.approx(model.losses[-1], abs=1e-9)
    model.save(str(tmp_path / "m"))
    again = BO.StagewiseClassifier.load(str(tmp_path / "m"))
    assert losses(again, rows) == pytest.approx(model.losses[-1], abs=1e-9)


def test_stops_after_rounds_without_a_better_loss(rows):
    noise = rows.withColumn("label", (F.xxhash64("date") % 2 == 0).cast("int"))
    model = BO.boost(noise, 4, rounds=40, depth=5, step=0.9, patience=2)
    best = min(range(len(model.losses)), key=model.losses.__getitem__)
    assert len(model.losses) == best + 3 < 40
    assert model.trees.getNumTrees == best + 1


def test_columns_are_drawn_per_tree_and_no_held_out_rows_keep_all(rows):
    model = BO.boost(rows.withColumn("is_val", F.lit(False)), 4, rounds=4, depth=4, columns=0.5, patience=1)
    assert model.losses == [] and model.trees.getNumTrees == 4
    used = [set(np.flatnonzero(t.featureImportances.toArray() > 0)) for t in model.trees.trees]
    assert all(len(u) <= 2 for u in used) and len(set().union(*used)) > 2


def test_a_first_leaf_is_gradient_over_hessian(spark):
    df = spark.createDataFrame([("t", i, int(i < 30), False, float(i < 40)) for i in range(100)], "ticker string, date int, label int, is_val boolean, a double")
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    model = BO.boost(df, 1, rounds=1, depth=1, step=1.0, subsample=1.0, columns=1.0)
    got = {r.a: r.p for r in model.score(df).select("a", "p").distinct().collect()}
    # 30 of the 40 upper rows are positive: (30 - 20) / (40 / 4) = 1; none of the lower: -30 / (60 / 4) = -2
    assert got[1.0] == pytest.approx(1 / (1 + math.exp(-1.0))) and got[0.0] == pytest.approx(1 / (1 + math.exp(2.0)))


def test_skipped_tickers_have_rows(spark):
    f = feature_matrix(bars_from_lineitem(spark, "/root/testdata/sf0.001"))
    few = f.where("ticker = 'N'").orderBy("date").limit(12).withColumn("ticker", F.lit("few"))
    both = f.where("ticker = 'N'").unionByName(few)
    _, _, metrics, _, scored = MD.train_classifier(both, dict(rounds=2, depth=2))
    got = {r.ticker: r for r in metrics.collect()}
    assert (got["few"].status, got["few"].n_rows, got["few"].logloss_val) == ("skipped", 11, None)
    assert got["N"].status == "ok" and got["N"].n_rows == got["N"].n_train + got["N"].n_val == scored.count()


def test_every_row_has_a_prediction_and_skipped_latest_rows_a_status(spark):
    f = feature_matrix(bars_from_lineitem(spark, "/root/testdata/sf0.001"))
    model, feats, _, _ = MD.train_regressor(f, dict(maxIter=2, maxDepth=2, seed=1))
    holes = f.withColumn("rsi_14", F.when(F.col("ticker") != "N", F.col("rsi_14")))
    scored = MD.score_regression(model, holes, feats)
    assert scored.count() == f.count() and scored.where("prediction is null").count() == 0
    got = {r.ticker: r for r in MD.predict_next(model, holes, feats).collect()}
    assert (got["N"].status, got["N"].predicted_return) == ("skipped", None)
    assert got["A"].status == "ok" and got["A"].predicted_return is not None
