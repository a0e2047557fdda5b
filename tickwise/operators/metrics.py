"""Aggregations and metrics (AG-01 … AG-24), grouped by any key columns.

All metrics are built-in aggregates with partial (map-side) combine.  The
rank-based ones (exact ROC AUC) use a two-level prefix sum so that no window
ever holds a whole group: scores are first reduced to distinct values, then
bucketed by value; prefix sums run inside (group, bucket) and over the
bucket totals.  Correlations come from one moment matrix per group (``moments``).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickwise.operators.quantiles import exact_quantile
from tickwise.operators.moments import Moments, grouped_moments
from tickwise.session import materialize

# The inner edges of 10 uniform bins on [0, 1] exactly as a
# ``linspace(0, 1, 11)`` produces them (i * 0.1 in binary floating point).
UNIFORM10_EDGES = [0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001,
                   0.7000000000000001, 0.8, 0.9, 1.0]


def _g(group):
    return [group] if isinstance(group, str) else list(group or [])


def regression_metrics(df: DataFrame, y: str, p: str, group=("ticker",)) -> DataFrame:
    """AG-01: RMSE, MAE and row count of predictions."""
    e = F.col(y) - F.col(p)
    return df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(*_g(group)).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        F.count(F.lit(1)).alias("n"))


def naive_baseline(df: DataFrame, y: str, group=("ticker",)) -> DataFrame:
    """AG-02: zero predictor RMSE / MAE and population std of the target."""
    v = F.col(y)
    return df.where(v.isNotNull()).groupBy(*_g(group)).agg(
        F.sqrt(F.avg(v * v)).alias("rmse_zero"), F.avg(F.abs(v)).alias("mae_zero"),
        F.stddev_pop(v).alias("std_target"), F.count(F.lit(1)).alias("n"))


def log_loss_expr(y: Column, p: Column, eps: float = 1e-15) -> Column:
    """AG-03 per row: eps inside each log."""
    return -(y * F.ln(p + F.lit(eps)) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p + F.lit(eps)))


def classification_metrics(df: DataFrame, y: str, p: str, group=("ticker",)) -> DataFrame:
    """AG-03 + AG-05: log loss and Brier score."""
    yy, pp = F.col(y).cast("double"), F.col(p)
    return df.where(yy.isNotNull() & pp.isNotNull()).groupBy(*_g(group)).agg(
        F.avg(log_loss_expr(yy, pp)).alias("logloss"),
        F.avg((pp - yy) * (pp - yy)).alias("brier"),
        F.count(F.lit(1)).alias("n"))


def prefix_sums(values: DataFrame, group: list[str], order: str, cols: list[str], buckets: int = 64) -> DataFrame:
    """``values`` (one row per group and distinct ``order``) with ``below_<c>``,
    the sum of ``c`` over the group's smaller values, and ``all_<c>``, over all.

    Two levels: buckets between approximate quantiles of the group's own values
    hold about equally many rows wherever the values crowd; a window runs
    inside one bucket, and bucket totals are summed apart.
    """
    values = materialize(values)
    cuts = F.percentile_approx(order, [k / buckets for k in range(1, buckets)], 20 * buckets)
    edges = values.groupBy(*group).agg(F.array_distinct(cuts).alias("_e"))
    s = values.join(edges, group).withColumn("_bk", F.size(F.filter("_e", lambda e: e <= F.col(order)))).drop("_e")
    inside = Window.partitionBy(*group, "_bk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    tot = s.groupBy(*group, "_bk").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    before, every = Window.partitionBy(*group).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*group)
    tot = tot.select(*group, "_bk", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0.0)).alias(f"_o_{c}") for c in cols],
                     *[F.sum(f"_t_{c}").over(every).alias(f"all_{c}") for c in cols])
    s = s.select(*values.columns, "_bk", *[F.coalesce(F.sum(c).over(inside), F.lit(0.0)).alias(f"_i_{c}") for c in cols])
    j = s.join(tot, [*group, "_bk"])
    return j.select(*values.columns, *[(F.col(f"_i_{c}") + F.col(f"_o_{c}")).alias(f"below_{c}") for c in cols], *[f"all_{c}" for c in cols])


def roc_auc(df: DataFrame, y: str, p: str, group=("ticker",), buckets: int = 64) -> DataFrame:
    """AG-04: exact ROC AUC, ties counted half; NULL with one class only.

    ``AUC = Σ_s pos_s · (neg_below_s + neg_s / 2) / (P · N)`` over distinct
    scores ``s``, with ``neg_below`` from two-level prefix sums.
    """
    g = _g(group)
    yy = F.col(y).cast("int")
    s = (df.where(F.col(p).isNotNull() & yy.isNotNull())
         .groupBy(*g, F.col(p).alias("_s"))
         .agg(F.sum(F.when(yy == 1, 1).otherwise(0)).cast("double").alias("_pos"),
              F.sum(F.when(yy == 1, 0).otherwise(1)).cast("double").alias("_neg")))
    j = prefix_sums(s, g, "_s", ["_neg"], buckets)
    contrib = F.col("_pos") * (F.col("below__neg") + F.col("_neg") / 2.0)
    a = j.groupBy(*g).agg(F.sum(contrib).alias("_num"), F.sum("_pos").alias("P"), F.sum("_neg").alias("N"))
    return a.select(*g, F.when((F.col("P") > 0) & (F.col("N") > 0),
                               F.col("_num") / (F.col("P") * F.col("N"))).alias("auc"),
                    F.col("P").cast("bigint").alias("n_pos"), F.col("N").cast("bigint").alias("n_neg"))


def _edges(vals) -> Column:
    return F.array(*[F.lit(float(v)) for v in vals])


def calibration_curve(df: DataFrame, y: str, p: str, group=("ticker",)) -> DataFrame:
    """AG-06: 10 uniform bins; a value on an inner edge goes to the lower bin;
    empty bins are absent.  bin = 1 + #(inner edges < p)."""
    inner = _edges(UNIFORM10_EDGES[1:-1])
    pp = F.col(p)
    b = F.size(F.filter(inner, lambda e: e < pp)) + 1
    return (df.where(pp.isNotNull() & F.col(y).isNotNull())
            .groupBy(*_g(group), b.cast("bigint").alias("bin"))
            .agg(F.avg(F.col(y).cast("double")).alias("prob_true"), F.avg(pp).alias("prob_pred"),
                 F.count(F.lit(1)).alias("n")))


def calibration_manual(df: DataFrame, y: str, p: str, group=("ticker",)) -> DataFrame:
    """AG-07: edge value goes to the upper bin, ``p = 1`` falls outside all
    bins, empty bins are kept with the bin midpoint and a NULL rate."""
    g = _g(group)
    pp = F.col(p)
    ind = F.size(F.filter(_edges(UNIFORM10_EDGES), lambda e: e <= pp)) - 1
    rows = (df.where(pp.isNotNull() & F.col(y).isNotNull())
            .select(*g, ind.alias("bin"), F.col(y).cast("double").alias("_y"), pp.alias("_p"))
            .where((F.col("bin") >= 0) & (F.col("bin") <= 9))
            .groupBy(*g, "bin").agg(F.avg("_y").alias("prob_true"), F.avg("_p").alias("_pp"),
                                    F.count(F.lit(1)).alias("n")))
    bins = (df.select(*g).distinct()
            .select(*g, F.explode(F.sequence(F.lit(0), F.lit(9))).alias("bin")))
    edges = _edges(UNIFORM10_EDGES)
    mid = (F.element_at(edges, F.col("bin") + 1) + F.element_at(edges, F.col("bin") + 2)) / 2.0
    out = bins.join(rows, [*g, "bin"], "left")
    return out.select(*g, F.col("bin").cast("bigint").alias("bin"), "prob_true",
                      F.coalesce(F.col("_pp"), mid).alias("prob_pred"),
                      F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def assess_bin(pred: Column, true: Column) -> Column:
    """AG-08: Good / Over / Under / Mixed from the bin's pred − true."""
    d = pred - true
    return (F.when(pred.isNull() | true.isNull(), "Mixed")
            .when(F.abs(d) <= 0.03, "Good").when(d > 0.05, "Over")
            .when(d < -0.05, "Under").otherwise("Mixed"))


def prob_band(p: Column, n: Column | None = None, z: float = 1.96) -> tuple[Column, Column, Column]:
    """AG-09: normal-approximation band, n defaults to 50, clipped to [0, 1]."""
    nn = F.lit(50) if n is None else F.when(n > 0, n).otherwise(F.lit(50))
    se = F.sqrt(p * (F.lit(1.0) - p) / F.greatest(F.lit(1), nn))
    return F.greatest(F.lit(0.0), p - z * se), F.least(F.lit(1.0), p + z * se), nn


def shape(df: DataFrame, group=("ticker",)) -> DataFrame:
    """AG-10: row count and column count."""
    return df.groupBy(*_g(group)).agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def missing_rate(df: DataFrame, cols: list[str], group=("ticker",)) -> DataFrame:
    """AG-11: mean over columns of each column's NULL, NaN or ±inf rate."""
    def miss(c):
        v = F.col(c)
        return F.avg((v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))).cast("double"))
    rates = [miss(c) for c in cols]
    return df.groupBy(*_g(group)).agg((sum(rates[1:], rates[0]) / F.lit(float(len(cols)))).alias("missing_rate"))


def row_fingerprint(cols: list[str]) -> list[Column]:
    """Two independent hashes of a whole row (192 bits): duplicate detection
    shuffles 24 bytes per row instead of the row itself."""
    j = F.to_json(F.struct(*[F.col(c) for c in cols]))
    return [F.xxhash64(j).alias("_h1"), F.md5(j).alias("_h2")]


def duplicate_rows(df: DataFrame, cols: list[str] | None = None, group=()) -> DataFrame:
    """AG-12: rows beyond the first of each identical row."""
    g = _g(group)
    cols = cols or [c for c in df.columns if c not in g]
    c = df.select(*g, *row_fingerprint(cols)).groupBy(*g, "_h1", "_h2").count()
    return c.groupBy(*g).agg(F.sum(F.col("count") - 1).cast("bigint").alias("n_duplicates"),
                             F.sum("count").cast("bigint").alias("n_rows"))


def quantile(df: DataFrame, col: str, q: float = 0.8, group=("ticker",), exact: bool = True) -> DataFrame:
    """AG-13: linear-interpolation quantile (exact, by rank selection where a group is large) or ``percentile_approx``."""
    name = f"q{int(round(q * 100))}"
    if exact:
        return exact_quantile(df, col, q, _g(group), name)
    return df.groupBy(*_g(group)).agg(F.percentile_approx(F.col(col).cast("double"), q, 10000).alias(name))


def correlation_long(df: DataFrame, cols: list[str], group=("ticker",), complete: bool = False) -> DataFrame:
    """AG-14: Pearson correlation of every column pair (pairwise complete),
    0 where a pair has none, long output (group, a, b, corr).

    One mergeable moment matrix per group and task; a row is read once and
    never multiplied by the pairs.
    """
    pairs = [(i, j) for i in range(len(cols)) for j in range(len(cols))]

    def finish(_: dict, m: Moments) -> list[tuple]:
        c = m.correlation()
        return [(cols[i], cols[j], float(c[i, j])) for i, j in pairs]

    return grouped_moments(df, cols, _g(group), "a string, b string, corr double", finish, complete)


def value_summary(df: DataFrame, col: str, group=("ticker",)) -> DataFrame:
    """AG-15 + AG-16: mean, median, population std, min, max and the share of
    positive values (percent, rounded)."""
    v = F.col(col)
    return df.where(v.isNotNull()).groupBy(*_g(group)).agg(
        F.avg(v).alias("mean"), F.percentile(v, 0.5).alias("median"), F.stddev_pop(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.round(F.lit(100.0) * F.avg((v > 0).cast("double"))).alias("pct_positive"),
        F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str, group=("ticker",), bins: int = 5) -> DataFrame:
    """AG-17: equal-width bins between min and max (width ≥ 1e-6), the max
    lands in the last bin, empty bins are kept with count 0."""
    g = _g(group)
    v = F.col(col)
    base = df.where(v.isNotNull()).select(*g, v.alias("_v"))
    rng = base.groupBy(*g).agg(F.min("_v").alias("mn"), F.max("_v").alias("mx"))
    width = F.greatest((F.col("mx") - F.col("mn")) / bins, F.lit(1e-6))
    rng = rng.withColumn("width", width)
    idx = F.least(F.floor((F.col("_v") - F.col("mn")) / F.col("width")), F.lit(bins - 1))
    counts = base.join(rng, g).groupBy(*g, idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select(*g, "mn", "width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, [*g, "bin"], "left")
    return out.select(*g, F.col("bin").cast("bigint").alias("bin"),
                      (F.col("mn") + F.col("width") * (F.col("bin") + 0.5)).alias("midpoint"),
                      F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def feature_profile(df: DataFrame, cols: list[str] | None = None, group=("ticker",)) -> DataFrame:
    """AG-19: NULL count and type of every column, long format."""
    g = _g(group)
    cols = cols or [c for c in df.columns if c not in g]
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    agg = df.groupBy(*g).agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    items = [F.struct(F.lit(c).alias("feature"), F.lit(types[c]).alias("dtype"),
                      F.col(c).cast("bigint").alias("null_count")) for c in cols]
    return agg.select(*g, F.explode(F.array(*items)).alias("x")).select(*g, "x.*")


def first_seen_values(df: DataFrame, col: str, order: list[str], n: int = 50) -> DataFrame:
    """AG-24: distinct values in order of first appearance, first ``n``.
    One aggregate (min of the order key per value) then a top-n."""
    key = F.struct(*[F.col(c) for c in order])
    firsts = df.groupBy(col).agg(F.min(key).alias("_first"))
    return (firsts.orderBy("_first", col).limit(n)
            .select(col, F.col("_first").alias("first_seen")))


def correlation_complete_case(df: DataFrame, cols: list[str], part: str = "ticker") -> DataFrame:
    """AG-14, complete-case variant: rows with any NULL are dropped first."""
    return correlation_long(df, cols, part, complete=True)
