"""Per-ticker standardisation and PCA (ML-09 … ML-12, AG-21, TK-07).

PCA by moments: one pass over the rows gives every ticker's mergeable moment
matrix (``moments``), and the task that merges a ticker's partials decomposes it
at once.  Components come back as a table and are applied to rows with native
array expressions.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickwise.functions.exprs import finite
from tickwise.operators.moments import Moments, grouped_moments


def _g(group):
    return [group] if isinstance(group, str) else list(group or [])


def _plain_inputs(cols: list[str], log_cols=("Volume",)) -> list[Column]:
    """PRJ-06: the columns as doubles, ``log1p`` of Volume (bad → 0)."""
    v = {c: F.col(c).cast("double") for c in cols}
    return [(F.log1p(F.coalesce(v[c], F.lit(0.0))) if c in log_cols else v[c]).alias(c) for c in cols]


def pca_inputs(features: DataFrame, cols: list[str], part: str = "ticker",
               log_cols=("Volume",)) -> DataFrame:
    """PRJ-02 + PRJ-06 + PRJ-03: non-finite → NULL, ``log1p`` of Volume
    (bad → 0), then complete rows only."""
    sel = [finite(v).alias(c) for c, v in zip(cols, _plain_inputs(cols, log_cols))]
    return features.select(part, "date", *sel).na.drop(subset=cols)


def scaler_stats(df: DataFrame, cols: list[str], group=("ticker",)) -> DataFrame:
    """ML-09 statistics: per-group mean and population std (zero or NULL std
    → scale 1), row count, and a constant-column flag (PRJ-05)."""
    g = _g(group)
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std"),
                 (F.min(c) == F.max(c)).alias(f"{c}__const")]
    a = df.groupBy(*g).agg(*aggs)
    return a.select(*g, "n",
                    F.array(*[F.col(f"{c}__mean") for c in cols]).alias("mean"),
                    F.array(*[F.when(F.coalesce(F.col(f"{c}__std"), F.lit(0.0)) == 0, F.lit(1.0))
                              .otherwise(F.col(f"{c}__std")) for c in cols]).alias("scale"),
                    F.array(*[F.coalesce(F.col(f"{c}__const"), F.lit(True)) for c in cols]).alias("const"))


def standardize(df: DataFrame, stats: DataFrame, cols: list[str], group=("ticker",),
                keep=("date",)) -> DataFrame:
    """ML-09: ``(x - mean) / scale`` per group.  The stats table has one row
    per group; the join is left to the planner (AQE turns it into a
    broadcast when the measured size is small)."""
    g = _g(group)
    j = df.join(stats.select(*g, "mean", "scale"), g)
    return j.select(*g, *keep, *[((F.col(c) - F.col("mean")[i]) / F.col("scale")[i]).alias(c)
                                 for i, c in enumerate(cols)])


def standardize_by_window(x: DataFrame, cols: list[str], part: str = "ticker",
                          keep=("date",)) -> DataFrame:
    """ML-09 without a join: per-ticker mean / population std as whole-
    partition window aggregates.  Rows coming out of the feature windows are
    already hash-partitioned and sorted by ticker, so this adds neither an
    exchange nor a sort, and the input is evaluated once.  The mean, scale
    and constant flags ride along as per-ticker constant array columns."""
    w = Window.partitionBy(part)
    means = [F.avg(c).over(w) for c in cols]
    stds = [F.stddev_pop(c).over(w) for c in cols]
    scales = [F.when(F.coalesce(sd, F.lit(0.0)) == 0, F.lit(1.0)).otherwise(sd) for sd in stds]
    consts = [F.coalesce(F.min(c).over(w) == F.max(c).over(w), F.lit(True)) for c in cols]
    t = x.select(part, *keep, *cols, F.array(*means).alias("mean"), F.array(*scales).alias("scale"),
                 F.array(*consts).alias("const"))
    return t.select(part, *keep, *[((F.col(c) - F.col("mean")[i]) / F.col("scale")[i]).alias(c)
                                   for i, c in enumerate(cols)], "mean", "scale", "const")


def covariance(z: DataFrame, cols: list[str], group=("ticker",)) -> DataFrame:
    """Population covariance of complete rows (upper triangle, long format) from one moment matrix per group."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]

    def finish(_: dict, m: Moments) -> list[tuple]:
        return [(cols[i], cols[j], float(m.products[i, j] / m.rows)) for i, j in pairs]

    return grouped_moments(z, cols, _g(group), "a string, b string, cov double", finish)


def eigen_components(m: Moments, n_components: int) -> tuple[list[float], list[list[float]], list[float], list[float], list[int]]:
    """Explained shares, components, means, scales and the columns that vary, from a group's moments of complete rows."""
    p = len(m.mean)
    std = np.sqrt(np.diag(m.products) / m.rows)
    keep = np.flatnonzero(std > 0)
    scale = np.where(std > 0, std, 1.0)
    if not len(keep):
        return [], [], m.mean.tolist(), scale.tolist(), []
    c = (m.products / m.rows / np.outer(scale, scale))[np.ix_(keep, keep)]
    w, v = np.linalg.eigh(c)
    w, v = np.clip(w[::-1], 0.0, None), v[:, ::-1]
    k = min(n_components, len(keep))
    v = v[:, :k] * np.where(v[np.abs(v).argmax(axis=0)[:k], np.arange(k)] < 0, -1.0, 1.0)
    full = np.zeros((k, p))
    full[:, keep] = v.T
    return (w[:k] / w.sum()).tolist(), full.tolist(), m.mean.tolist(), scale.tolist(), keep.tolist()


def fit_pca(features: DataFrame, cols: list[str], n_components: int = 5,
            group=("ticker",)) -> tuple[DataFrame, DataFrame]:
    """ML-10 / ML-11: PCA of every group.  Returns ``(meta, z)`` where meta
    holds ``n_components, explained_variance_ratio, components, mean, scale,
    feature_order`` per group and ``z`` the standardised rows.

    Constant columns of a group are left out of its decomposition (their
    loadings are 0 and they are absent from ``feature_order``).  Signs are
    fixed so that the largest absolute loading of each component is positive.
    Groups without a column that varies have no row.
    """
    g = _g(group)
    x = pca_inputs(features, cols, g[0])
    names = list(cols)

    def finish(_: dict, m: Moments) -> list[tuple]:
        ratio, comps, mean, scale, keep = eigen_components(m, n_components)
        return [(m.rows, len(comps), ratio, comps, mean, scale, [names[i] for i in keep])] if keep else []

    schema = ("n_rows bigint, n_components int, explained_variance_ratio array<double>, components array<array<double>>, "
              "mean array<double>, scale array<double>, feature_order array<string>")
    # the moments leave out incomplete rows themselves: no second, wide filter over all columns
    meta = grouped_moments(features.select(*g, *_plain_inputs(cols)), cols, g, schema, finish, complete=True)
    return meta, standardize_by_window(x, cols, g[0]).drop("mean", "scale", "const")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def pca_scores(z: DataFrame, meta: DataFrame, cols: list[str], group=("ticker",),
               keep=("date",)) -> DataFrame:
    """Scores of standardised rows: ``pc_j = components_j · z``."""
    g = _g(group)
    zv = z.select(*g, *keep, F.array(*[F.col(c) for c in cols]).alias("_z"))
    j = zv.join(meta.select(*g, "components"), g)
    return j.select(*g, *keep, F.transform("components", lambda comp: dot(comp, F.col("_z"))).alias("pc"))


def project_vectors(vectors: DataFrame, meta: DataFrame, vec: str = "features",
                    group=("ticker",)) -> DataFrame:
    """ML-12: raw vector → PCA space, ``components · ((x - mean) / scale)``.
    (The reference forgets the division by scale; this divides.)"""
    g = _g(group)
    j = vectors.join(meta.select(*g, "components", "mean", "scale"), g)
    zz = F.zip_with(F.zip_with(F.col(vec), F.col("mean"), lambda x, m: x - m), F.col("scale"),
                    lambda d, s: d / s)
    return j.select(*[c for c in vectors.columns], F.transform("components", lambda comp: dot(comp, zz)).alias("pc"))


def cumulative_variance(meta: DataFrame, threshold: float = 0.8, group=("ticker",)) -> DataFrame:
    """AG-21: cumulative explained variance per component and the number of
    components needed to reach ``threshold`` (all when never reached)."""
    g = _g(group)
    e = meta.select(*g, F.posexplode("explained_variance_ratio").alias("i", "ratio"))
    w = Window.partitionBy(*g).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("cumulative", F.sum("ratio").over(w))
    need = e.groupBy(*g).agg(F.coalesce(F.min(F.when(F.col("cumulative") >= threshold, F.col("i") + 1)),
                                        F.max(F.col("i") + 1)).alias("n_for_threshold"))
    return e.join(need, g).select(*g, (F.col("i") + 1).alias("component"), "ratio", "cumulative",
                                  "n_for_threshold")


def top_loadings(meta: DataFrame, cols: list[str], n: int = 5, group=("ticker",)) -> DataFrame:
    """TK-07: the ``n`` largest |loading| per component, signed values."""
    g = _g(group)
    names = F.array(*[F.lit(c) for c in cols])
    e = meta.select(*g, F.posexplode("components").alias("i", "comp"))
    e = e.select(*g, (F.col("i") + 1).alias("component"),
                 F.posexplode("comp").alias("j", "loading")).where(F.col("loading") != 0)
    w = Window.partitionBy(*g, "component").orderBy(F.abs("loading").desc(), "j")
    e = e.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return e.select(*g, "component", "rank", F.element_at(names, F.col("j") + 1).alias("feature"), "loading")
