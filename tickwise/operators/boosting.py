"""Stage-wise boosting that goes on from round to round (ML-04).

Every row carries its margin.  A round draws rows (by hash) and columns (a seeded
choice per tree), fits one Spark ML regression tree to the Newton targets
gradient / Hessian with the Hessian as weight, so that a leaf holds their ratio,
and adds its shrunken prediction to the margins.  The held-out loss of each
round is kept; boosting stops once it has not improved for ``patience`` rounds,
and the trees up to the best round are the model.  No tree is fitted twice.

Scale: trees are grown by Spark ML over all rows; a round reads the rows as the
tree learner does and aggregates one loss.  Margins are checkpointed every
``KEEP_EVERY`` rounds, so that the lineage holds that many trees at most.
"""
from __future__ import annotations

import random
from dataclasses import dataclass, field

from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickwise.session import materialize

KEEP_EVERY = 10
#: Smallest Hessian: a row that is all but certain still has a finite target.
LEAST_HESSIAN = 1e-6


def probability(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def log_loss(label: Column, margin: Column) -> Column:
    """-log of the probability given to the label: log(1 + e^-m) for 1 and log(1 + e^m) for 0, for margins of any size."""
    m = F.when(label == 1, margin).otherwise(-margin)
    return F.greatest(-m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))


@dataclass
class StagewiseClassifier:
    """Trees whose shrunken sum is the margin of the positive class; ``losses`` is the held-out loss after each fitted round."""

    trees: GBTRegressionModel
    losses: list[float] = field(default_factory=list)

    def score(self, rows: DataFrame, out: str = "p") -> DataFrame:
        """``rows`` (with ``features``) and the probability of the positive class."""
        return self.trees.transform(rows).withColumn(out, probability(F.col("prediction"))).drop("prediction")

    def save(self, path: str) -> None:
        self.trees.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> StagewiseClassifier:
        return cls(GBTRegressionModel.load(path))


def _sum_of(spark: SparkSession, trees: list[DecisionTreeRegressionModel], step: float) -> GBTRegressionModel:
    """One model of the weighted trees: a single expression, saved and loaded as Spark ML does."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kinds = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(jvm.double, len(trees))
    for i, t in enumerate(trees):
        kinds[i], weights[i] = t._java_obj, float(step)
    made = jvm.org.apache.spark.ml.regression.GBTRegressionModel("stagewise", kinds, weights)
    return GBTRegressionModel(made)


def stopped_at(losses: list[float], patience: int) -> tuple[int, bool]:
    """The number of rounds with the lowest loss, and whether ``patience`` rounds passed since without a better one."""
    best = min(range(len(losses)), key=losses.__getitem__) if losses else -1
    return best + 1, len(losses) - 1 - best >= patience


def boost(rows: DataFrame, n_features: int, rounds: int = 200, depth: int = 5, step: float = 0.1, subsample: float = 0.8, columns: float = 0.8,
          patience: int = 10, seed: int = 42, key: tuple[str, ...] = ("ticker", "date")) -> StagewiseClassifier:
    """A classifier from ``rows`` of ``key``, ``label`` 0 / 1, ``features`` and ``is_val``.

    Without held-out rows all rounds are fitted and kept.
    """
    spark = rows.sparkSession
    state = rows.select(F.xxhash64(*key).alias("_h"), F.col("label").cast("double").alias("label"), "features", "is_val", F.lit(0.0).alias("_m"))
    state = materialize(state)
    draw, trees, losses = random.Random(seed), [], []
    width = max(1, round(columns * n_features))
    held = not state.where("is_val").isEmpty()
    for k in range(rounds):
        chosen = draw.sample(range(n_features), width)
        mask = ElementwiseProduct(scalingVec=Vectors.dense([float(i in set(chosen)) for i in range(n_features)]), inputCol="features", outputCol="_x")
        p = probability(F.col("_m"))
        hessian = F.greatest(p * (1.0 - p), F.lit(LEAST_HESSIAN))
        drawn = F.pmod(F.xxhash64("_h", F.lit(seed), F.lit(k)), F.lit(1_000_000)) < int(subsample * 1_000_000)
        train = state.where(~F.col("is_val") & drawn).withColumn("_w", hessian).withColumn("_t", (F.col("label") - p) / F.col("_w"))
        learner = DecisionTreeRegressor(featuresCol="_x", labelCol="_t", weightCol="_w", predictionCol="_d", maxDepth=depth, seed=seed + k)
        tree = learner.fit(mask.transform(train).select("_x", "_t", "_w"))
        trees.append(tree)
        # the tree never splits a column that was masked, so it reads the whole features
        state = tree.setFeaturesCol("features").transform(state).withColumn("_m", F.col("_m") + step * F.col("_d")).drop("_d")
        if (k + 1) % KEEP_EVERY == 0:
            state = materialize(state)
        if held:
            losses.append(state.where("is_val").agg(F.avg(log_loss(F.col("label"), F.col("_m")))).first()[0])
            if stopped_at(losses, patience)[1]:
                break
    keep = stopped_at(losses, patience)[0] if held else len(trees)
    return StagewiseClassifier(_sum_of(spark, trees[:keep], step), losses)
