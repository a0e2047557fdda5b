"""Grouped KMeans and cluster reports (ML-13 … ML-18, AG-18, AG-23, TK-05/06).

Seeding is k-means++: each next centre is drawn with probability ∝ D² using an
exponential race, ``argmin(-ln u / D²)`` with ``u`` a seeded hash of the row:
exact D²-weighted sampling, deterministic for a seed.

* A group of up to ``GROUP_ROWS`` rows is clustered inside one task, all groups
  by one shuffle (``lloyd``): its steps keep distance bounds per row in memory,
  so settled rows aren't compared with the centres again, and no step is a job.
* A larger group is spread over all tasks: a Lloyd step joins its rows to one
  row of ``k`` centres, picks the nearest with array expressions and averages
  per (ticker, cluster) with map-side partial aggregation; the tiny centre table
  is checkpointed every step, and groups whose centres rest leave the loop.

Both follow the same rules (seeds, ties to the lowest centre, an empty cluster
keeps its centre) and differ by rounding alone.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickwise.operators.joins import query_blocks
from tickwise.operators.lloyd import lloyd, seed_centers
from tickwise.session import checkpoint_dir, ship


def _g(group):
    return [group] if isinstance(group, str) else list(group or [])


def dist2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def distance(a: Column, b: Column) -> Column:
    """SCL-01: Euclidean distance."""
    return F.sqrt(dist2(a, b))


def _uniform(key: list[str], seed: int, rnd: int) -> Column:
    h = F.xxhash64(*[F.col(c) for c in key], F.lit(seed), F.lit(rnd))
    return (F.abs(h % F.lit(1 << 52)) + 1).cast("double") / float((1 << 52) + 1)


def nearest(x: Column, centers: Column) -> tuple[Column, Column]:
    """ML-15: (index of the nearest centre, squared distance); ties → lowest."""
    d2s = F.transform(centers, lambda c: dist2(c, x))
    return (F.array_position(d2s, F.array_min(d2s)) - 1).cast("int"), F.array_min(d2s)


#: Largest group that is clustered inside a task.
GROUP_ROWS = 200_000


def _kmeans_in_tasks(rows: DataFrame, g: list[str], key: list[str], k: int, max_iter: int, tol: float) -> DataFrame:
    """``(group, key, cluster_label, d2, centers, n_iter, converged)``: the last three on one row of each group."""
    kept = rows.select(*g, *key).schema
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields],
                        "cluster_label int, d2 double, centers array<array<double>>, n_iter int, converged boolean"])

    def run(table: pa.Table) -> pa.Table:
        x, u = (np.array(table.column(c).to_pylist(), float) for c in ("x", "u"))
        label, d2, centers, n_iter, rests, _ = lloyd(x, seed_centers(x, u, k), max_iter, tol)
        rest = [None] * (len(x) - 1)
        added = {"cluster_label": pa.array(label, pa.int32()), "d2": pa.array(d2), "centers": pa.array([centers.tolist(), *rest], pa.list_(pa.list_(pa.float64()))),
                 "n_iter": pa.array([n_iter, *rest], pa.int32()), "converged": pa.array([rests, *rest], pa.bool_())}
        return pa.table({**{c: table.column(c) for c in (*g, *key)}, **added})

    ship(rows.sparkSession)
    return rows.groupBy(*g).applyInArrow(run, schema)


def kmeans(points: DataFrame, cols: list[str], k: int = 5, group=("ticker",), key=("date",),
           seed: int = 42, max_iter: int = 300, tol: float = 1e-4, group_rows: int = GROUP_ROWS):
    """ML-13: KMeans per group on the given (already scaled) columns.

    Returns ``(labels, centers, summary)``: labels (group, key, cluster_label,
    d2), centers (group, centers array<array<double>>), summary (group,
    n_rows, inertia, sizes array<bigint>, status, n_iter, converged).  Groups
    with fewer than ``k`` rows have a summary row with status ``skipped`` and
    no other values.  ``max_iter`` is the reference library's default; a group
    that still moves then is marked ``converged = false``.
    """
    g, key = _g(group), list(key)
    spark = points.sparkSession
    checkpoint_dir(spark)
    pts = points.select(*g, *key, F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    # Written once to the shared checkpoint folder: every iteration then
    # starts from a plain scan (short lineage, survives executor loss).
    every = pts.checkpoint()
    counts = every.groupBy(*g).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    small = counts.where(F.col("_n") < k)
    fits = counts.where(F.col("_n").between(k, group_rows)).select(*g)
    races = every.withColumn("u", F.array(*[_uniform(g + key, seed, j) for j in range(k)]))
    local = _kmeans_in_tasks(races.join(fits, g, "left_semi"), g, key, k, max_iter, tol).checkpoint()
    labels, done = local.select(*g, *key, "cluster_label", "d2"), local.where("centers is not null").select(*g, "centers", "n_iter", "converged")
    large = counts.where((F.col("_n") >= k) & (F.col("_n") > group_rows)).select(*g)
    if not large.isEmpty():
        more, ended = _kmeans_by_steps(every.join(large, g, "left_semi").checkpoint(), g, key, len(cols), k, seed, max_iter, tol)
        labels, done = labels.unionByName(more), done.unionByName(ended)
    cen = done.select(*g, "centers")
    summary = labels.groupBy(*g).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("d2").alias("inertia"))
    sizes = (labels.groupBy(*g, "cluster_label").agg(F.count(F.lit(1)).alias("cnt"))
             .groupBy(*g).agg(F.map_from_entries(F.collect_list(F.struct("cluster_label", "cnt"))).alias("_sz")))
    summary = summary.join(sizes, g).select(
        *g, "n_rows", "inertia",
        F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                    lambda i: F.coalesce(F.element_at("_sz", i), F.lit(0).cast("bigint"))).alias("sizes"),
        F.lit("ok").alias("status"))
    summary = summary.join(done.select(*g, "n_iter", "converged"), g)
    skipped = small.select(*g, F.col("_n").alias("n_rows"), F.lit("skipped").alias("status"))
    return labels, cen, summary.unionByName(skipped, allowMissingColumns=True)


def _kmeans_by_steps(pts: DataFrame, g: list[str], key: list[str], p: int, k: int, seed: int, max_iter: int, tol: float) -> tuple[DataFrame, DataFrame]:
    """Labels and ``(group, centers, n_iter, converged)`` of groups too large for a task."""
    # k-means++ seeding by exponential races
    cen = pts.groupBy(*g).agg(F.min_by("x", _uniform(g + key, seed, 0)).alias("c0"))
    cen = cen.select(*g, F.array("c0").alias("centers")).checkpoint()
    for j in range(1, k):
        d2 = F.array_min(F.transform("centers", lambda c: dist2(c, F.col("x"))))
        score = F.when(d2 > 0, -F.ln(_uniform(g + key, seed, j)) / d2)
        nxt = pts.join(cen, g).groupBy(*g).agg(F.min_by("x", score).alias("_c"),
                                                   F.first("centers").alias("_old"))
        cen = nxt.select(*g, F.concat("_old", F.array(F.coalesce("_c", F.element_at("_old", 1))))
                         .alias("centers")).checkpoint()

    # groups whose centres rest leave the loop; only the others are read again
    rest, moving = None, cen
    for it in range(1, max_iter + 1):
        lab, _ = nearest(F.col("x"), F.col("centers"))
        a = pts.join(moving, g).select(*g, lab.alias("_cid"), "x")
        means = a.groupBy(*g, "_cid").agg(F.array(*[F.avg(F.col("x")[i]) for i in range(p)]).alias("_m"))
        upd = means.groupBy(*g).agg(F.map_from_entries(F.collect_list(F.struct("_cid", "_m"))).alias("_mp"))
        new = moving.join(upd, g, "left").select(
            *g, F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                            lambda i: F.coalesce(F.element_at("_mp", i), F.element_at("centers", i + 1))
                            ).alias("centers"), F.col("centers").alias("_prev"))
        new = new.withColumn("_shift", F.aggregate(F.zip_with("centers", "_prev", lambda c, o: dist2(c, o)),
                                                   F.lit(0.0), lambda s, v: s + v)).checkpoint()
        still = F.coalesce(F.col("_shift"), F.lit(0.0)) > tol
        last = it == max_iter
        done = new.where(F.lit(True) if last else ~still).select(*g, "centers", F.lit(it).alias("n_iter"), (~still).alias("converged"))
        rest = done if rest is None else rest.unionByName(done)
        moving = new.where(still).select(*g, "centers")
        if last or moving.isEmpty():
            break
    done = rest.checkpoint()
    lab, d2 = nearest(F.col("x"), F.col("centers"))
    labels = pts.join(done.select(*g, "centers"), g).select(*g, *key, lab.alias("cluster_label"), d2.alias("d2"))
    return labels, done


def assign_to_centers(rows: DataFrame, centers: DataFrame, vec: str, group=("ticker",),
                      scale: DataFrame | None = None) -> DataFrame:
    """ML-15: nearest centre and all distances for each row vector.  With a
    scaler table (mean, scale arrays; zero scale → 1) rows are scaled first."""
    g = _g(group)
    if g:
        j = rows.join(centers, g)
    else:  # one row of centres for all rows
        j = query_blocks(rows, centers).withColumn("centers", F.element_at("queries", 1)["centers"])
    x = F.col(vec)
    if scale is not None:
        j = j.join(scale.select(*g, "mean", "scale"), g)
        x = F.zip_with(F.zip_with(x, F.col("mean"), lambda a, m: a - m), F.col("scale"),
                       lambda d, s: d / F.when(s == 0, 1.0).otherwise(s))
    d = F.transform("centers", lambda c: distance(c, x))
    lab = (F.array_position(d, F.array_min(d)) - 1).cast("int")
    return j.select(*rows.columns, lab.alias("cluster"), d.alias("distances"))


def label_counts(labels: DataFrame, group=("ticker",)) -> DataFrame:
    """AG-18: rows per cluster and inertia contribution."""
    g = _g(group)
    return labels.groupBy(*g, "cluster_label").agg(F.count(F.lit(1)).alias("count"),
                                                   F.sum("d2").alias("inertia"))


def representatives(labelled: DataFrame, n: int = 5, since=None, until=None,
                    group=("ticker",)) -> DataFrame:
    """ML-16 + TK-05: newest ``n`` rows per (ticker, cluster) in a date range."""
    from tickwise.operators.projections import date_range
    g = _g(group)
    d = date_range(labelled, since, until)
    w = Window.partitionBy(*g, "cluster_label").orderBy(F.col("date").desc())
    return d.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def interpret_centers(centers_long: DataFrame, group=("ticker",), high: float = 0.66,
                      low: float = 0.33) -> DataFrame:
    """ML-18 + TK-06 + ST-03 on centres in original units, long format
    (group, cluster, feature, value).

    Each feature's centres are ranked 0…1 ((rank-1)/(k-1), k = 1 → .5); the
    return (else log_return), vol_10, rsi_14 and macd ranks give labels
    joined with " + " (order kept, duplicates removed), else Neutral.  Top
    features are the 4 largest |value − median over centres|.
    """
    g = _g(group)
    wf = Window.partitionBy(*g, "feature")
    k = F.count(F.lit(1)).over(wf)
    r = (F.row_number().over(wf.orderBy("value", "cluster")) - 1)
    c = centers_long.select("*", F.when(k > 1, r / (k - 1)).otherwise(F.lit(0.5)).alias("rank"),
                            F.percentile("value", 0.5).over(wf).alias("_med"))
    has_ret = F.max((F.col("feature") == "return").cast("int")).over(Window.partitionBy(*g)) == 1
    ret_name = F.when(has_ret, F.lit("return")).otherwise(F.lit("log_return"))

    def part(feat: Column | str, hi_label: str, lo_label: str, idx: int):
        f = F.col("feature") == (feat if isinstance(feat, Column) else F.lit(feat))
        lab = F.when(F.col("rank") >= high, hi_label).when(F.col("rank") <= low, lo_label)
        return F.max(F.when(f, F.struct(F.lit(idx).alias("i"), lab.alias("l"))))

    parts = c.withColumn("_retname", ret_name)
    rank_feat = Window.partitionBy(*g, "cluster").orderBy(F.abs(F.col("value") - F.col("_med")).desc(), "feature")
    parts = parts.withColumn("_top", F.row_number().over(rank_feat))
    agg = parts.groupBy(*g, "cluster").agg(
        part(F.col("_retname"), "Positive Return", "Negative Return", 0).alias("p0"),
        part("vol_10", "High Volatility", "Low Volatility", 1).alias("p1"),
        part("rsi_14", "Overbought", "Oversold", 2).alias("p2"),
        part("macd", "Bullish MACD", "Bearish MACD", 3).alias("p3"),
        F.sort_array(F.collect_list(F.when(F.col("_top") <= 4, F.struct(
            F.col("_top").alias("pos"), "feature", "value", F.col("rank").alias("percentile")))))
        .alias("top_features"))
    labels = F.array_compact(F.array(F.col("p0.l"), F.col("p1.l"), F.col("p2.l"), F.col("p3.l")))
    label = F.when(F.size(labels) == 0, "Neutral").otherwise(F.array_join(F.array_distinct(labels), " + "))
    return agg.select(*g, "cluster", label.alias("label"), "top_features")


def centers_long(centers: DataFrame, cols: list[str], group=("ticker",),
                 scaler: DataFrame | None = None) -> DataFrame:
    """Explode a centres table to (group, cluster, feature, value), un-scaled
    with ``value * scale + mean`` when a scaler table is given."""
    g = _g(group)
    names = F.array(*[F.lit(c) for c in cols])
    c = centers
    if scaler is not None:
        c = c.join(scaler.select(*g, "mean", "scale"), g)
    e = c.select(*g, *(["mean", "scale"] if scaler is not None else []),
                 F.posexplode("centers").alias("cluster", "center"))
    e = e.select(*g, *(["mean", "scale"] if scaler is not None else []), "cluster",
                 F.posexplode("center").alias("j", "value"))
    val = F.col("value")
    if scaler is not None:
        val = val * F.col("scale")[F.col("j")] + F.col("mean")[F.col("j")]
    return e.select(*g, "cluster", F.element_at(names, F.col("j") + 1).alias("feature"), val.alias("value"))
