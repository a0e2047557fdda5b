"""Queries for PCA, clustering and neighbours (ML-09 … ML-18, ML-26/27)."""
from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from tickwise.functions.exprs import present
from tickwise.operators import cluster as CL
from tickwise.operators import neighbors as NB
from tickwise.operators import pca as PC
from tickwise.operators import pivot_index as PX
from tickwise.operators.timeseries import FEATURE_COLUMNS
from tickwise.plans.catalog import register
from tickwise.plans.q_timeseries import features
from tickwise.plans.sqlparts import R, features_sql
from tickwise.session import materialize, scratch_path
from tickwise.sources.tables import read_table

PCA_COLS = [c for c in FEATURE_COLUMNS if c != "date"]          # 27, as the flow uses
FEAT3 = f"({features_sql()})"
_DIST = "sqrt(list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"


def _z_sql(log_volume: bool = True) -> str:
    def x(c):
        return f'ln(1 + CAST("{c}" AS DOUBLE))' if (c == "Volume" and log_volume) else f'CAST("{c}" AS DOUBLE)'
    inner = ", ".join(f'{x(c)} AS "{c}"' for c in PCA_COLS)
    zs = ", ".join(
        f'("{c}" - avg("{c}") OVER t) / (CASE WHEN coalesce(stddev_pop("{c}") OVER t, 0) = 0 THEN 1.0 '
        f'ELSE stddev_pop("{c}") OVER t END) AS "{c}"' for c in PCA_COLS)
    return f"""(SELECT ticker, date, {zs} FROM (SELECT ticker, date, {inner} FROM {FEAT3})
                WINDOW t AS (PARTITION BY ticker))"""


Z_SQL = _z_sql()


def _pca_parts(spark, sf, key="l_returnflag"):
    return PC.fit_pca(features(spark, sf, key), PCA_COLS, 5)


@register("standardized_features", "ML-09, PRJ-06",
          f"SELECT ticker, date, {', '.join(R(chr(34) + c + chr(34), chr(34) + c + chr(34)) for c in PCA_COLS)} FROM {Z_SQL}")
def q_standardized(spark, sf):
    x = PC.pca_inputs(features(spark, sf), PCA_COLS)
    return present(PC.standardize_by_window(x, PCA_COLS).drop("mean", "scale", "const"))


def _cov_sql() -> str:
    pairs = [(i, j) for i in range(len(PCA_COLS)) for j in range(i, len(PCA_COLS))]
    items = ", ".join(f"struct_pack(a := '{PCA_COLS[i]}', b := '{PCA_COLS[j]}', "
                      f"cov := sum(\"{PCA_COLS[i]}\" * \"{PCA_COLS[j]}\") / count(*))" for i, j in pairs)
    return f"""SELECT ticker, x.a AS a, x.b AS b, {R('x.cov', 'cov')} FROM (
        SELECT ticker, unnest([{items}]) AS x FROM {Z_SQL} GROUP BY ticker)"""


@register("pca_covariance", "ML-10 (moments), ML-09", _cov_sql())
def q_cov(spark, sf):
    x = PC.pca_inputs(features(spark, sf), PCA_COLS)
    z = PC.standardize_by_window(x, PCA_COLS).drop("mean", "scale", "const")
    return present(PC.covariance(z, PCA_COLS))


@register("pca_components", "ML-10, ML-11")
def q_pca(spark, sf):
    meta, _ = _pca_parts(spark, sf, "l_suppkey")
    e = meta.select("ticker", "n_rows", "n_components",
                    F.posexplode(F.arrays_zip("explained_variance_ratio", "components")).alias("i", "c"))
    return e.select("ticker", "n_rows", "n_components", (F.col("i") + 1).alias("component"),
                    F.col("c.explained_variance_ratio").alias("ratio"), F.col("c.components").alias("loadings"))


def _eigen_sql() -> str:
    pairs = [(i, j) for i in range(len(PCA_COLS)) for j in range(i + 1, len(PCA_COLS))]
    cols = [f'ln(1 + CAST("{c}" AS DOUBLE))' if c == "Volume" else f'CAST("{c}" AS DOUBLE)' for c in PCA_COLS]
    squares = " + ".join(f"2 * coalesce(corr({cols[i]}, {cols[j]}), 0.0) ** 2" for i, j in pairs)
    varying = " + ".join(f"CAST(min({c}) < max({c}) AS INTEGER)" for c in cols)
    return f"""SELECT ticker, count(*) AS n_rows, CAST({varying} AS BIGINT) AS n_components, {R(f'({varying}) + {squares}', 'sum_of_squared_eigenvalues', 4)},
           true AS solves_eigen_equation, true AS orthonormal, true AS falling FROM {FEAT3} GROUP BY ticker"""


@register("pca_eigen_checks", "ML-09, ML-10, ML-11, AG-21", _eigen_sql())
def q_pca_eigen(spark, sf):
    """All components: the eigen equation against the covariance, and the eigenvalues' squares, which SQL has from the correlations."""
    f = features(spark, sf)
    meta, z = PC.fit_pca(f, PCA_COLS, len(PCA_COLS))
    meta = materialize(meta)
    z, p = materialize(z), len(PCA_COLS)
    cov = PC.covariance(z, PCA_COLS).select("ticker", "a", "b", "cov")
    cov = cov.unionByName(cov.where("a <> b").select("ticker", F.col("b").alias("a"), F.col("a").alias("b"), "cov"))
    names = F.array(*[F.lit(c) for c in PCA_COLS])
    parts = meta.select("ticker", F.posexplode(F.arrays_zip("explained_variance_ratio", "components")).alias("i", "c"), F.size("feature_order").alias("n"))
    parts = parts.select("ticker", "i", (F.col("c.explained_variance_ratio") * F.col("n")).alias("value"), F.posexplode("c.components").alias("j", "v"))
    parts = parts.withColumn("b", F.element_at(names, F.col("j") + 1))
    left = cov.join(parts.select("ticker", "i", "b", "v"), ["ticker", "b"]).groupBy("ticker", "i", "a").agg(F.sum(F.col("cov") * F.col("v")).alias("cv"))
    gap = left.join(parts.select("ticker", "i", F.col("b").alias("a"), (F.col("value") * F.col("v")).alias("lv")), ["ticker", "i", "a"])
    gap = gap.groupBy("ticker").agg((F.max(F.abs(F.col("cv") - F.col("lv"))) < 1e-8).alias("solves_eigen_equation"))
    dots = F.flatten(F.transform("components", lambda x, i: F.transform("components", lambda y, j: F.abs(PC.dot(x, y) - F.when(i == j, 1.0).otherwise(0.0)))))
    value = F.transform("explained_variance_ratio", lambda r: r * F.size("feature_order"))
    own = meta.select("ticker", "n_rows", F.col("n_components").cast("bigint").alias("n_components"),
                      F.aggregate(value, F.lit(0.0), lambda s, v: s + v * v).alias("sum_of_squared_eigenvalues"), (F.array_max(dots) < 1e-9).alias("orthonormal"),
                      (F.col("explained_variance_ratio") == F.sort_array("explained_variance_ratio", asc=False)).alias("falling"))
    return present(own.join(gap, "ticker"), per_column={"sum_of_squared_eigenvalues": 4})


@register("pca_variance_curve", "AG-21")
def q_pca_curve(spark, sf):
    meta, _ = _pca_parts(spark, sf)
    return PC.cumulative_variance(meta)


@register("pca_top_loadings", "TK-07")
def q_pca_top(spark, sf):
    meta, _ = _pca_parts(spark, sf)
    return PC.top_loadings(meta, PCA_COLS, 5)


@register("pca_scores", "ML-10 scores, SRC-15")
def q_pca_scores(spark, sf):
    meta, z = _pca_parts(spark, sf)
    return PC.pca_scores(z, meta, PCA_COLS)


@register("pca_score_norms", "ML-10, ML-12, PRJ-12, SRC-15", f"""
    SELECT ticker, date, {R('list_sum(list_transform(v, lambda x: x * x))', 'squared_norm', 4)},
           {R('CASE WHEN date = max(date) OVER (PARTITION BY ticker) THEN list_sum(list_transform(v, lambda x: x * x)) END', 'projected', 4)}
    FROM (SELECT ticker, date, [{', '.join(f'"{c}"' for c in PCA_COLS)}] AS v FROM {Z_SQL})""")
def q_pca_norms(spark, sf):
    """Scores on all components keep every row's length, and so does the raw latest row's projection."""
    from tickwise.operators.projections import latest_row
    f, meta, scores = _all_components(spark, sf)
    raw = latest_row(PC.pca_inputs(f, PCA_COLS)).select("ticker", "date", F.array(*[F.col(c) for c in PCA_COLS]).alias("features"))
    last = PC.project_vectors(raw, meta).select("ticker", "date", PC.dot(F.col("pc"), F.col("pc")).alias("projected"))
    rows = scores.select("ticker", "date", PC.dot(F.col("pc"), F.col("pc")).alias("squared_norm")).join(last, ["ticker", "date"], "left")
    return present(rows, per_column={"squared_norm": 4, "projected": 4})


@register("pca_project_latest", "ML-12, PRJ-12")
def q_pca_project(spark, sf):
    from tickwise.operators.projections import latest_row
    f = features(spark, sf)
    meta, _ = PC.fit_pca(f, PCA_COLS, 5)
    raw = latest_row(PC.pca_inputs(f, PCA_COLS))
    v = raw.select("ticker", "date", F.array(*[F.col(c) for c in PCA_COLS]).alias("features"))
    return PC.project_vectors(v, meta)


@register("pca_similar_days", "ML-26, TK-04, JN-04, AG-15")
def q_pca_knn(spark, sf):
    meta, z = _pca_parts(spark, sf)
    s = PC.pca_scores(z, meta, PCA_COLS)
    t = NB.newest_targets(s, "pc")
    nb = NB.knn(s, t, "pc", 10)
    nxt = _next_returns(spark, sf)
    return nb.join(nxt, ["ticker", "date"], "left")


_DATE = "1995-06-15"
_K = 5


def _recommend_sql(targets: str, keep_self: bool) -> str:
    """Neighbours among all standardised rows: with every component kept, PCA space is a rotation of them."""
    vec = "[" + ", ".join(f'"{c}"' for c in PCA_COLS) + "]"
    return f"""
    WITH z AS (SELECT ticker, date, {vec} AS v FROM {Z_SQL}),
    t AS ({targets}),
    d AS (SELECT t.ticker, t.target, z.date, {_DIST.format(a='z.v', b='t.tv')} AS distance FROM t JOIN z USING (ticker)
          {'' if keep_self else 'WHERE z.date <> t.target'}),
    n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY distance, date) AS rank FROM d) WHERE rank <= {_K}),
    r AS (SELECT ticker, date, Close, (lead(Close) OVER w - Close) / Close AS next_return FROM {FEAT3} WINDOW w AS (PARTITION BY ticker ORDER BY date))
    SELECT n.ticker, n.target, n.rank, n.date, {R('n.distance', 'distance', 4)}, {R('r.Close', 'Close')}, {R('r.next_return', 'next_return')},
           {R('avg(r.next_return) OVER (PARTITION BY n.ticker)', 'mean_next_return')},
           {R('quantile_cont(r.next_return, 0.5) OVER (PARTITION BY n.ticker)', 'median_next_return')},
           {R('stddev_pop(r.next_return) OVER (PARTITION BY n.ticker)', 'std_next_return')}
    FROM n LEFT JOIN r USING (ticker, date)"""


def _recommended(df):
    cols = ["ticker", "target", "rank", "date", "distance", "Close", "next_return", "mean_next_return", "median_next_return", "std_next_return"]
    return present(df.select(*cols), per_column={"distance": 4})


def _all_components(spark, sf):
    f = features(spark, sf)
    meta, z = PC.fit_pca(f, PCA_COLS, len(PCA_COLS))
    meta = materialize(meta)
    return f, meta, PC.pca_scores(z, meta, PCA_COLS)


@register("recommend_by_date", "ML-26, TK-04, JN-04, AG-15", _recommend_sql(
    f"""SELECT ticker, date AS target, v AS tv FROM z QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY (date = DATE '{_DATE}') DESC, date DESC) = 1""", False))
def q_recommend_date(spark, sf):
    """The days most like a given one; tickers without it ask for their newest."""
    _, _, scores = _all_components(spark, sf)
    return _recommended(NB.recommend(scores, NB.newest_targets(scores, "pc", date=_DATE), "pc", _next_returns(spark, sf), _K))


@register("recommend_from_vector", "ML-27, ML-12, TK-04, AG-15", _recommend_sql(
    "SELECT ticker, max(date) AS target, [" + ", ".join(f"avg(v[{i + 1}])" for i in range(len(PCA_COLS))) + "] AS tv "
    "FROM (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 5) GROUP BY ticker", True))
def q_recommend_vector(spark, sf):
    """The days most like a raw vector, here the mean of the newest five rows; no row is left out."""
    f, meta, scores = _all_components(spark, sf)
    newest = F.row_number().over(Window.partitionBy("ticker").orderBy(F.col("date").desc()))
    raw = PC.pca_inputs(f, PCA_COLS).withColumn("_r", newest).where("_r <= 5")
    raw = raw.groupBy("ticker").agg(F.max("date").alias("date"), F.array(*[F.avg(c) for c in PCA_COLS]).alias("features"))
    return _recommended(NB.recommend(scores, PC.project_vectors(raw, meta), "pc", _next_returns(spark, sf), _K, exclude_self=False))


def _next_returns(spark, sf, key="l_returnflag"):
    f = features(spark, sf, key)
    w = Window.partitionBy("ticker").orderBy("date")
    return f.select("ticker", "date", "Close",
                    F.try_divide(F.lead("Close").over(w) - F.col("Close"), F.col("Close")).alias("next_return"))


# ---- clustering ---------------------------------------------------------------
KM_COLS = PCA_COLS


_KM: dict = {}


def _kmeans(spark, sf, key="l_returnflag", k=5):
    """One KMeans fit per (session, folder, key, k), shared by the cluster
    queries (the fit's iterations run eagerly; results are checkpointed)."""
    ck = (spark.sparkContext.applicationId, sf, key, k)
    if ck not in _KM:
        _KM[ck] = _kmeans_fit(spark, sf, key, k)
    return _KM[ck]


def _kmeans_fit(spark, sf, key, k):
    f = features(spark, sf, key)
    x = PC.pca_inputs(f, KM_COLS, log_cols=())          # KMeans does not log Volume
    zx = PC.standardize_by_window(x, KM_COLS)
    stats = zx.groupBy("ticker").agg(F.first("mean").alias("mean"), F.first("scale").alias("scale"))
    z = zx.drop("mean", "scale", "const")
    labels, centers, summary = CL.kmeans(z, KM_COLS, k=k, seed=42)
    return f, stats, labels, centers, summary


@register("kmeans_clusters", "ML-13, AG-18")
def q_kmeans(spark, sf):
    _, _, _, _, summary = _kmeans(spark, sf)
    return summary


@register("kmeans_checks", "ML-13, ML-15, AG-18", f"""
    SELECT ticker, count(*) AS n_rows, true AS sizes_match, true AS labels_are_nearest, true AS centers_are_means, true AS inertia_matches, true AS below_one_cluster
    FROM {FEAT3} GROUP BY ticker""")
def q_kmeans_checks(spark, sf):
    """What makes a clustering one: nearest labels, centres that rest at their rows' means, sizes and inertia of the summary."""
    f, _, labels, centers, summary = _kmeans(spark, sf)
    z = PC.standardize_by_window(PC.pca_inputs(f, KM_COLS, log_cols=()), KM_COLS).select("ticker", "date", F.array(*[F.col(c) for c in KM_COLS]).alias("x"))
    rows = materialize(z.join(labels, ["ticker", "date"]).join(centers, "ticker"))
    near, d2 = CL.nearest(F.col("x"), F.col("centers"))
    each = rows.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_and(near == F.col("cluster_label")).alias("labels_are_nearest"), F.sum(d2).alias("again"),
        (F.sum(d2) < F.sum(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))).alias("below_one_cluster"))
    means = rows.groupBy("ticker", "cluster_label").agg(F.array(*[F.avg(F.col("x")[i]) for i in range(len(KM_COLS))]).alias("m"), F.first("centers").alias("centers"),
                                                        F.count(F.lit(1)).alias("n"))
    rest = means.groupBy("ticker").agg((F.max(CL.dist2(F.col("m"), F.get("centers", F.col("cluster_label")))) < 1e-3).alias("centers_are_means"),
                                       F.sort_array(F.collect_list("n")).alias("sizes_again"))
    s = summary.where("status = 'ok'").select("ticker", "inertia", F.sort_array(F.filter("sizes", lambda n: n > 0)).alias("sizes"))
    out = each.join(rest, "ticker").join(s, "ticker")
    return out.select("ticker", "n_rows", (F.col("sizes") == F.col("sizes_again")).alias("sizes_match"), "labels_are_nearest", "centers_are_means",
                      (F.abs(F.col("inertia") - F.col("again")) < 1e-6 * F.col("inertia")).alias("inertia_matches"), "below_one_cluster")


@register("kmeans_label_counts", "AG-18")
def q_kmeans_counts(spark, sf):
    _, _, labels, _, _ = _kmeans(spark, sf)
    return CL.label_counts(labels)


@register("kmeans_pca_clusters", "ML-14")
def q_kmeans_pca(spark, sf):
    meta, z = _pca_parts(spark, sf)
    s = PC.pca_scores(z, meta, PCA_COLS)
    s = s.select("ticker", "date", *[F.col("pc")[i].alias(f"pc{i + 1}") for i in range(5)])
    _, _, summary = CL.kmeans(s, [f"pc{i + 1}" for i in range(5)], k=5, seed=42)
    return summary


@register("cluster_samples", "ML-16, TK-05, PRJ-08")
def q_cluster_samples(spark, sf):
    f, _, labels, _, _ = _kmeans(spark, sf)
    lab = f.join(labels.select("ticker", "date", "cluster_label"), ["ticker", "date"])
    return CL.representatives(lab.select("ticker", "date", "cluster_label", "Close", "return"),
                              5, "1996-01-01", "2000-12-31")


@register("labelled_features", "ML-17, JN-01", f"""
    SELECT ticker, date, {R('Close', 'Close')}, {R('rsi_14', 'rsi_14')}, true AS has_label FROM {FEAT3}""")
def q_labelled(spark, sf):
    f, _, labels, _, _ = _kmeans(spark, sf)
    j = f.join(labels.select("ticker", "date", "cluster_label"), ["ticker", "date"])
    return present(j.select("ticker", "date", "Close", "rsi_14", F.col("cluster_label").between(0, 4).alias("has_label")))


@register("cluster_interpret_kmeans", "ML-18, TK-06, ST-03")
def q_interpret_km(spark, sf):
    _, stats, _, centers, _ = _kmeans(spark, sf)
    return CL.interpret_centers(CL.centers_long(centers, KM_COLS, scaler=stats))


@register("cluster_row_counts", "AG-23", f"""
    SELECT ticker, count(*) AS feature_rows, count(*) AS training_rows, true AS has_latest_label FROM {FEAT3} GROUP BY ticker""")
def q_cluster_counts(spark, sf):
    f, _, labels, _, _ = _kmeans(spark, sf)
    n_feat = f.groupBy("ticker").agg(F.count(F.lit(1)).alias("feature_rows"))
    n_lab = labels.groupBy("ticker").agg(F.count(F.lit(1)).alias("training_rows"),
                                         F.max_by("cluster_label", "date").between(0, 4).alias("has_latest_label"))
    return n_feat.join(n_lab, "ticker", "left")


# Return-quintile profiles: a deterministic grouping whose centres the
# interpretation operator can be checked on exactly.
def _quintile_centers_sql() -> str:
    cols = ", ".join(f'avg(CAST("{c}" AS DOUBLE)) AS "{c}"' for c in KM_COLS)
    items = ", ".join(f"struct_pack(feature := '{c}', value := \"{c}\")" for c in KM_COLS)
    return f"""(SELECT ticker, cluster, x.feature AS feature, x.value AS value FROM (
        SELECT ticker, cluster, unnest([{items}]) AS x FROM (
          SELECT ticker, CAST(q - 1 AS INTEGER) AS cluster, {cols} FROM (
            SELECT *, ntile(5) OVER (PARTITION BY ticker ORDER BY "return", date) AS q FROM {FEAT3})
          GROUP BY ticker, q)))"""


def _quintile_centers(spark, sf):
    f = features(spark, sf)
    q = F.ntile(5).over(Window.partitionBy("ticker").orderBy("return", "date"))
    f = f.withColumn("cluster", (q - 1).cast("int"))
    wide = f.groupBy("ticker", "cluster").agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in KM_COLS])
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in KM_COLS])
    return wide.select("ticker", "cluster", F.explode(items).alias("x")).select("ticker", "cluster", "x.*")


_INTERP_SQL = f"""
    WITH c AS {_quintile_centers_sql()},
    r AS (SELECT *, CASE WHEN count(*) OVER f > 1
                     THEN (row_number() OVER (PARTITION BY ticker, feature ORDER BY value, cluster) - 1)
                          / (count(*) OVER f - 1) ELSE 0.5 END AS rank,
                 quantile_cont(value, 0.5) OVER f AS med
          FROM c WINDOW f AS (PARTITION BY ticker, feature)),
    t AS (SELECT *, row_number() OVER (PARTITION BY ticker, cluster ORDER BY abs(value - med) DESC, feature) AS top FROM r),
    lab AS (SELECT ticker, cluster,
       max(CASE WHEN feature = 'return' THEN CASE WHEN rank >= 0.66 THEN 'Positive Return' WHEN rank <= 0.33 THEN 'Negative Return' END END) AS l0,
       max(CASE WHEN feature = 'vol_10' THEN CASE WHEN rank >= 0.66 THEN 'High Volatility' WHEN rank <= 0.33 THEN 'Low Volatility' END END) AS l1,
       max(CASE WHEN feature = 'rsi_14' THEN CASE WHEN rank >= 0.66 THEN 'Overbought' WHEN rank <= 0.33 THEN 'Oversold' END END) AS l2,
       max(CASE WHEN feature = 'macd' THEN CASE WHEN rank >= 0.66 THEN 'Bullish MACD' WHEN rank <= 0.33 THEN 'Bearish MACD' END END) AS l3,
       string_agg(CASE WHEN top <= 4 THEN feature END, ',' ORDER BY top) AS top_features
       FROM t GROUP BY ticker, cluster)
    SELECT ticker, CAST(cluster AS BIGINT) AS cluster,
           CASE WHEN len(list_filter([l0, l1, l2, l3], lambda x: x IS NOT NULL)) = 0 THEN 'Neutral'
                ELSE array_to_string(list_filter([l0, l1, l2, l3], lambda x: x IS NOT NULL), ' + ') END AS label,
           top_features
    FROM lab"""


@register("cluster_interpret_quintiles", "ML-18, TK-06, ST-03", _INTERP_SQL)
def q_interpret_q(spark, sf):
    r = CL.interpret_centers(_quintile_centers(spark, sf))
    return r.select("ticker", F.col("cluster").cast("bigint").alias("cluster"), "label",
                    F.array_join(F.transform("top_features", lambda s: s["feature"]), ",").alias("top_features"))


# ---- vectors: embeddings ----------------------------------------------------
def _emb(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return e.select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("v"))


_EMB = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def _targets(e):
    return e.groupBy("label").agg(F.min_by(F.struct("vec_id", "v"), "vec_id").alias("t")).select("label", "t.*")


@register("embedding_target_distance", "SCL-01, JN-05", f"""
    WITH e AS {_EMB}, t AS (SELECT label, arg_min(v, vec_id) AS tv FROM e GROUP BY label)
    SELECT e.vec_id, e.label, {R(_DIST.format(a='e.v', b='t.tv'), 'distance')} FROM e JOIN t USING (label)""")
def q_emb_dist(spark, sf):
    e = _emb(spark, sf)
    t = _targets(e).select("label", F.col("v").alias("tv"))
    j = e.join(t, "label")
    return present(j.select("vec_id", "label", CL.distance(F.col("v"), F.col("tv")).alias("distance")))


_KNN_SQL = f"""
    WITH e AS {_EMB}, t AS (SELECT label, min(vec_id) AS target FROM e GROUP BY label),
    tv AS (SELECT t.label, t.target, e.v AS tv FROM t JOIN e ON e.vec_id = t.target),
    d AS (SELECT tv.target, e.vec_id, {_DIST.format(a='e.v', b='tv.tv')} AS distance
          FROM tv CROSS JOIN e WHERE e.vec_id <> tv.target)
    SELECT target, vec_id, {R('distance', 'distance')}, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY target ORDER BY distance, vec_id) AS rank FROM d) WHERE rank <= 10"""


@register("embedding_knn", "ML-27, TK-04", _KNN_SQL)
def q_emb_knn(spark, sf):
    e = _emb(spark, sf)
    t = _targets(e)
    nb = NB.knn(e, t, "v", 10, group=(), key="vec_id")
    return present(nb.select("target", "vec_id", "distance", F.col("rank").cast("bigint").alias("rank")))


@register("embedding_knn_indexed", "ML-26, ML-27, TK-04, JN-05", _KNN_SQL)
def q_emb_knn_indexed(spark, sf):
    """The same neighbours by way of a stored index, of which most shards stay closed."""
    e = _emb(spark, sf)
    path = scratch_path(spark, f"pivot-index-{uuid.uuid4().hex}")
    PX.build_index(e, path, "vec_id", "v")
    nb, _ = PX.search(spark, path, _targets(e).select("vec_id", "v"), "vec_id", "v", 10)
    return present(nb.select("target", F.col("key").alias("vec_id"), "distance", F.col("rank").cast("bigint").alias("rank")))


@register("nearest_centroid", "ML-15, JN-05", f"""
    WITH e AS {_EMB},
    c AS (SELECT label, list(a ORDER BY i) AS cv FROM (
            SELECT label, i, avg(v[i]) AS a FROM e CROSS JOIN range(1, 65) r(i) GROUP BY label, i) GROUP BY label),
    d AS (SELECT e.vec_id, e.label, c.label AS centroid, {_DIST.format(a='e.v', b='c.cv')} AS distance FROM e CROSS JOIN c)
    SELECT vec_id, label, CAST(centroid AS BIGINT) AS assigned, {R('distance', 'distance')} FROM d
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, centroid) = 1""")
def q_nearest_centroid(spark, sf):
    e = _emb(spark, sf)
    cent = e.groupBy("label").agg(F.array(*[F.avg(F.col("v")[i]) for i in range(64)]).alias("c"))
    ordered = cent.agg(F.sort_array(F.collect_list(F.struct("label", "c"))).alias("s")).select(
        F.transform("s", lambda x: x["c"]).alias("centers"), F.transform("s", lambda x: x["label"]).alias("labels"))
    a = CL.assign_to_centers(e, ordered.select("centers"), "v", group=())
    a = a.join(ordered.select(F.posexplode("labels").alias("cluster", "assigned")), "cluster")
    d = F.element_at("distances", F.col("cluster") + 1)
    return present(a.select("vec_id", "label", F.col("assigned").cast("bigint").alias("assigned"),
                            d.alias("distance")))
