"""Data-quality, drift and performance gates (DQ-01 … DQ-10).

Each check yields long rows ``(group…, name, severity, value, details)``;
severity is one of ok / warning / severe and the overall status is the worst
severity per group (DQ-10).  Everything is a grouped aggregate or a window
keyed by (group, feature); no table is collected.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickwise.functions.exprs import finite
from tickwise.operators import metrics as M
from tickwise.session import materialize

SEVERITY_RANK = {"ok": 0, "warning": 1, "severe": 2}


def _g(group):
    return [group] if isinstance(group, str) else list(group or [])


def check_row(name: str, severity: Column, value: Column, details: Column | None = None):
    return F.struct(F.lit(name).alias("name"), severity.alias("severity"),
                    value.cast("double").alias("value"),
                    (details if details is not None else F.lit(None).cast("string")).alias("details"))


def integrity_checks(df: DataFrame, numeric_cols: list[str], group=("ticker",),
                     date_col: str | None = "date", order_col: str | None = None,
                     expected: DataFrame | None = None) -> DataFrame:
    """DQ-01 (+ DQ-02 when ``order_col`` gives the file order): row count,
    mean missing rate, duplicate rows, date monotonic in file order.  A group
    of ``expected`` without any row has ``file_non_empty`` severe."""
    g = _g(group)
    shape = M.shape(df, g)
    miss = M.missing_rate(df, numeric_cols, g)
    dups = M.duplicate_rows(df, [c for c in df.columns if c not in g], g).drop("n_rows")
    t = shape.join(miss, g, "left").join(dups, g, "left")
    if expected is not None:
        t = expected.select(*g).distinct().join(t, g, "left").fillna(0, ["n_rows", "n_cols"])
    rows = [
        check_row("file_non_empty", F.when(F.col("n_rows") > 0, "ok").otherwise("severe"), F.col("n_rows"),
                  F.to_json(F.struct(F.col("n_rows").alias("rows"), F.col("n_cols").alias("cols")))),
        check_row("missingness", F.when(F.col("missing_rate") > 0.30, "severe")
                  .when(F.col("missing_rate") > 0.10, "warning").otherwise("ok"), F.col("missing_rate")),
        check_row("duplicate_rows", F.when(F.col("n_duplicates") > 0, "warning").otherwise("ok"),
                  F.col("n_duplicates")),
    ]
    out = t.select(*g, F.explode(F.array(*rows)).alias("c")).select(*g, "c.*")
    if date_col and order_col:
        mono = monotonic_violations(df, order_col, date_col, g)
        out = out.unionByName(mono.select(*g, F.explode(F.array(check_row(
            "date_monotonic", F.when(F.col("n_violations") == 0, "ok").otherwise("warning"),
            F.col("n_violations")))).alias("c")).select(*g, "c.*"))
    return out


def monotonic_violations(df: DataFrame, order_col: str, value_col: str, group=(),
                         bucket: int = 1 << 20) -> DataFrame:
    """DQ-02: rows whose value is below the previous row's value in file
    order (NULL values skipped).  Two-level: ``lag`` inside (group, order
    bucket) windows, then one comparison per bucket boundary between the
    first value of a bucket and the last value of the previous non-empty
    bucket — no window ever spans a whole group."""
    g = _g(group)
    d = df.where(F.col(value_col).isNotNull()).select(
        *g, F.col(order_col).alias("_o"), F.col(value_col).alias("_v"),
        F.floor(F.col(order_col) / bucket).alias("_bk"))
    w = Window.partitionBy(*g, "_bk").orderBy("_o")
    inner = (d.withColumn("_bad", (F.col("_v") < F.lag("_v").over(w)).cast("int"))
             .groupBy(*g, "_bk").agg(F.coalesce(F.sum("_bad"), F.lit(0)).alias("_nb"),
                                     F.min_by("_v", "_o").alias("_first"),
                                     F.max_by("_v", "_o").alias("_last"),
                                     F.count(F.lit(1)).alias("_n")))
    wb = Window.partitionBy(*g).orderBy("_bk")
    edge = inner.withColumn("_edge", (F.col("_first") < F.lag("_last").over(wb)).cast("int"))
    return edge.groupBy(*g).agg(
        (F.sum("_nb") + F.coalesce(F.sum("_edge"), F.lit(0))).cast("bigint").alias("n_violations"),
        F.sum("_n").cast("bigint").alias("n_rows"))


def _long(df: DataFrame, cols: list[str], g: list[str], side: int) -> DataFrame:
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"),
                                      finite(F.col(c).cast("double")).alias("v")) for c in cols]))
    return df.select(*g, kv.alias("kv")).select(*g, "kv.feature", "kv.v", F.lit(side).alias("side"))


def ks_statistic(baseline: DataFrame, current: DataFrame, cols: list[str], group=("ticker",)) -> DataFrame:
    """DQ-03: two-sample KS D per (group, feature) with right-continuous CDFs;
    NULL/NaN/inf removed; an empty side gives D = 0.  The samples are tagged
    and unioned (ST-01), reduced to counts per distinct value, and the CDFs
    are two-level prefix sums over the value order."""
    g = _g(group)
    u = _long(baseline, cols, g, 0).unionByName(_long(current, cols, g, 1))
    valid = F.col("v").isNotNull()
    c = materialize(u.groupBy(*g, "feature", "v").agg(
        F.sum(F.when(valid & (F.col("side") == 0), 1).otherwise(0)).cast("double").alias("cx"),
        F.sum(F.when(valid & (F.col("side") == 1), 1).otherwise(0)).cast("double").alias("cy")))
    # a missing value has no counts; it keeps a feature without values in the result
    shown = c.where(valid)
    empty = c.select(*g, "feature").distinct().join(shown.select(*g, "feature").distinct(), [*g, "feature"], "left_anti")
    c = M.prefix_sums(shown, [*g, "feature"], "v", ["cx", "cy"])
    c = c.select(*g, "feature", (F.col("below_cx") + F.col("cx")).alias("sx"), (F.col("below_cy") + F.col("cy")).alias("sy"),
                 F.col("all_cx").alias("nx"), F.col("all_cy").alias("ny"))
    none = F.lit(0.0)
    c = c.unionByName(empty.select(*g, "feature", none.alias("sx"), none.alias("sy"), none.alias("nx"), none.alias("ny")))
    a = c.groupBy(*g, "feature").agg(
        F.max(F.abs(F.try_divide(F.col("sx"), F.col("nx")) - F.try_divide(F.col("sy"), F.col("ny")))).alias("d"),
        F.max("nx").alias("nx"), F.max("ny").alias("ny"))
    d = F.when((F.col("nx") > 0) & (F.col("ny") > 0), F.col("d")).otherwise(F.lit(0.0))
    return a.select(*g, "feature", d.alias("ks_d"), F.col("nx").cast("bigint").alias("n_base"),
                    F.col("ny").cast("bigint").alias("n_cur"))


def ks_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    """DQ-04: asymptotic two-sample KS p-value.  The alternating series
    ``2 Σ (-1)^(j-1) exp(-2 j² λ²)`` is summed up to and including the first
    term below 1e-10 in magnitude, at most 100 terms; clamped to [0, 1]."""
    en = F.sqrt(n1 * n2 / (n1 + n2))
    lam = (en + F.lit(0.12) + F.lit(0.11) / en) * d
    seq = F.sequence(F.lit(1), F.lit(100))

    def term(j):
        sign = F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        return F.lit(2.0) * sign * F.exp(F.lit(-2.0) * (j * j) * (lam * lam))

    stop = F.coalesce(F.array_min(F.filter(seq, lambda j: F.abs(term(j)) < 1e-10)), F.lit(100))
    s = F.aggregate(F.slice(F.transform(seq, term), 1, stop), F.lit(0.0), lambda a, x: a + x)
    return (F.when((n1 <= 0) | (n2 <= 0), F.lit(1.0)).when(lam <= 0, F.lit(1.0))
            .otherwise(F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0))))


def drift_columns(baseline: DataFrame, current: DataFrame, cols: list[str] | None = None,
                  group=("ticker",), pvalue_threshold: float = 0.001, d_threshold: float = 0.15,
                  window: int | None = None) -> DataFrame:
    """DQ-03/04 per column with the severe flag (p < threshold and D > .15).
    Shared columns are the intersection of the two schemas (JN-06)."""
    g = _g(group)
    if cols is None:
        from tickwise.operators.projections import numeric_columns
        bc = set(numeric_columns(baseline, tuple(g)))
        cols = [c for c in numeric_columns(current, tuple(g)) if c in bc]
    if window:
        from tickwise.operators.projections import last_n_rows
        current = last_n_rows(current, window, g[0] if g else "ticker")
    k = ks_statistic(baseline, current, cols, g)
    p = ks_pvalue(F.col("ks_d"), F.col("n_base"), F.col("n_cur"))
    k = k.withColumn("p_value", p)
    return k.withColumn("is_severe", (F.col("p_value") < pvalue_threshold) & (F.col("ks_d") > d_threshold))


def drift_verdict(cols_df: DataFrame, group=("ticker",)) -> DataFrame:
    """DQ-05: table severe if ≥ 25 % of shared columns are severe, warning
    if any, else ok."""
    g = _g(group)
    a = cols_df.groupBy(*g).agg(F.count(F.lit(1)).alias("shared_columns"),
                                F.sum(F.col("is_severe").cast("int")).alias("severe_count"),
                                F.sort_array(F.collect_list(F.when(F.col("is_severe"), F.col("feature"))))
                                .alias("severe_features"))
    frac = F.col("severe_count") / F.greatest(F.col("shared_columns"), F.lit(1))
    return a.select(*g, F.col("shared_columns").cast("bigint"), F.col("severe_count").cast("bigint"),
                    "severe_features", frac.alias("fraction_severe"),
                    F.when(frac >= 0.25, "severe").when(frac > 0, "warning").otherwise("ok").alias("severity"))


def drift_checks(baseline: DataFrame, current: DataFrame, metric: str = "ks", group=("ticker",),
                 **kw) -> DataFrame:
    """DQ-05 + DQ-06 as check rows.  An unknown metric or no shared column
    yields one warning row per group (decided at plan time)."""
    g = _g(group)
    groups = current.select(*g).distinct()
    if metric.lower() != "ks":
        return groups.select(*g, F.explode(F.array(check_row(
            "drift_metric", F.lit("warning"), F.lit(None)))).alias("c")).select(*g, "c.*")
    from tickwise.operators.projections import numeric_columns
    bc = set(numeric_columns(baseline, tuple(g)))
    shared = [c for c in numeric_columns(current, tuple(g)) if c in bc]
    if not shared:
        return groups.select(*g, F.explode(F.array(check_row(
            "drift_shared_columns", F.lit("warning"), F.lit(0)))).alias("c")).select(*g, "c.*")
    v = drift_verdict(drift_columns(baseline, current, shared, g, **kw), g)
    return v.select(*g, F.explode(F.array(check_row(
        "data_drift", F.col("severity"), F.col("fraction_severe"),
        F.to_json(F.struct("shared_columns", "severe_count", "severe_features"))))).alias("c")).select(*g, "c.*")


def _with_expected(counts: DataFrame, expected: DataFrame | None, g: list[str]) -> DataFrame:
    if expected is None:
        return counts
    return expected.select(*g).distinct().join(counts, g, "left").fillna(0, ["n_rows"])


def missing_artifacts(kind: str, expected: DataFrame, stored: DataFrame, group=("ticker",)) -> DataFrame:
    """DQ-09: a ``<kind>_artifacts`` warning for every expected group without stored metadata."""
    g = _g(group)
    lost = expected.select(*g).distinct().join(stored.select(*g).distinct(), g, "left_anti")
    row = check_row(f"{kind}_artifacts", F.lit("warning"), F.lit(None), F.lit("no stored metadata"))
    return lost.select(*g, row.alias("c")).select(*g, "c.*")


def regressor_gate(scored: DataFrame, y: str, p: str, stored: DataFrame | None = None,
                   group=("ticker",), order: str = "date", min_rows: int = 50,
                   expected: DataFrame | None = None) -> DataFrame:
    """DQ-07: score the last 20 % of rows; severe when RMSE exceeds 3 × the
    stored RMSE (or 0.10 without one); fewer than ``min_rows`` → warning.
    Groups of ``expected`` without a scored row have that warning too, and
    those without stored metadata a ``regressor_artifacts`` warning (DQ-09)."""
    g = _g(group)
    d = scored.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    w = Window.partitionBy(*g).orderBy(order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*g))
    d = d.select(*g, y, p, F.row_number().over(w).alias("_rn"), n.alias("_n"))
    test = d.where(F.col("_rn") > F.floor(F.col("_n") * 0.8))
    m = M.regression_metrics(test, y, p, g)
    cnt = d.groupBy(*g).agg(F.max("_n").alias("n_rows"))
    t = _with_expected(cnt, expected, g).join(m, g, "left")
    if stored is not None:
        t = t.join(stored.select(*g, F.col("rmse").alias("baseline_rmse")), g, "left")
    else:
        t = t.withColumn("baseline_rmse", F.lit(None).cast("double"))
    bad = F.when(F.col("baseline_rmse") > 0, F.col("rmse") > F.col("baseline_rmse") * 3.0) \
        .otherwise(F.col("rmse") > 0.10)
    sev = (F.when(F.col("n_rows") < min_rows, "warning").when(bad, "severe").otherwise("ok"))
    return t.select(*g, F.explode(F.array(check_row(
        "regressor_performance", sev, F.col("rmse"),
        F.to_json(F.struct("rmse", "mae", "baseline_rmse"))))).alias("c")).select(*g, "c.*").transform(
            lambda rows: rows if expected is None or stored is None else rows.unionByName(missing_artifacts("regressor", expected, stored, g)))


def classifier_gate(scored: DataFrame, y: str, p: str, group=("ticker",), order: str = "date",
                    min_rows: int = 50, expected: DataFrame | None = None) -> DataFrame:
    """DQ-08: last 20 % of rows; severe if log loss > 1 or AUC < .5; groups of
    ``expected`` without a scored row → warning."""
    g = _g(group)
    d = scored.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    w = Window.partitionBy(*g).orderBy(order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*g))
    d = d.select(*g, y, p, F.row_number().over(w).alias("_rn"), n.alias("_n"))
    test = d.where(F.col("_rn") > F.floor(F.col("_n") * 0.8))
    cm = M.classification_metrics(test, y, p, g).drop("n", "brier")
    auc = M.roc_auc(test, y, p, g).select(*g, "auc")
    cnt = d.groupBy(*g).agg(F.max("_n").alias("n_rows"))
    t = _with_expected(cnt, expected, g).join(cm, g, "left").join(auc, g, "left")
    bad = (F.col("logloss") > 1.0) | F.coalesce(F.col("auc") < 0.5, F.lit(False))
    sev = F.when(F.col("n_rows") < min_rows, "warning").when(bad, "severe").otherwise("ok")
    return t.select(*g, F.explode(F.array(check_row(
        "classifier_performance", sev, F.col("logloss"),
        F.to_json(F.struct("logloss", "auc"))))).alias("c")).select(*g, "c.*")


def feature_count_check(expected: DataFrame, provided: int, group=("ticker",)) -> DataFrame:
    """DQ-09: expected feature count (from model metadata) vs provided."""
    g = _g(group)
    sev = F.when(F.col("n_expected").isNull(), "warning") \
        .when(F.col("n_expected") != provided, "warning").otherwise("ok")
    return expected.select(*g, F.explode(F.array(check_row(
        "feature_count", sev, F.col("n_expected")))).alias("c")).select(*g, "c.*")


def overall_status(checks: DataFrame, group=("ticker",)) -> DataFrame:
    """DQ-10: worst severity per group."""
    g = _g(group)
    rank = (F.when(F.col("severity") == "severe", 2).when(F.col("severity") == "warning", 1).otherwise(0))
    a = checks.groupBy(*g).agg(F.max(rank).alias("_r"), F.count(F.lit(1)).alias("n_checks"))
    return a.select(*g, F.when(F.col("_r") == 2, "severe").when(F.col("_r") == 1, "warning")
                    .otherwise("ok").alias("overall_status"), F.col("n_checks").cast("bigint"))


def exit_code(status: DataFrame, gate: bool = True) -> int:
    """DQ-10: what a job that ran the checks exits with: 2 when the gate is
    on and any group is severe, else 0."""
    return 2 if gate and not status.where(F.col("overall_status") == "severe").isEmpty() else 0


def check_run(features: DataFrame, numeric_cols: list[str], baseline: DataFrame, initialised: DataFrame,
              expected: DataFrame | None = None, gates=(), group=("ticker",)) -> DataFrame:
    """All checks of a run as rows: integrity (DQ-01), drift against the stored
    baseline (DQ-03 … DQ-06), ``baseline_initialized`` for groups that had none
    (SRC-16), and the rows of the model ``gates`` (DQ-07 … DQ-09)."""
    g = _g(group)
    integ = integrity_checks(features, numeric_cols, g, expected=expected)
    old = features.join(initialised.select(*g), g, "left_anti").select(*features.columns)
    drift = drift_checks(baseline.join(initialised.select(*g), g, "left_anti").select(*baseline.columns), old, group=g)
    new = initialised.select(*g, check_row("baseline_initialized", F.lit("ok"), F.lit(None)).alias("c")).select(*g, "c.*")
    return union_checks(integ, drift, new, *gates)


def union_checks(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drift_profile(baseline: DataFrame, current: DataFrame, cols: list[str], group=("ticker",),
                  **kw) -> DataFrame:
    """AG-20: per feature the reference mean, current mean, KS D, p-value
    and severe flag, plus per group ``severe_count``."""
    g = _g(group)

    def means(df, name):
        kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), finite(F.col(c).cast("double")).alias("v"))
                                 for c in cols]))
        return (df.select(*g, kv.alias("kv")).select(*g, "kv.*").groupBy(*g, "feature")
                .agg(F.avg("v").alias(name)))
    d = drift_columns(baseline, current, cols, g, **kw)
    out = d.join(means(baseline, "reference_mean"), [*g, "feature"]).join(means(current, "current_mean"),
                                                                          [*g, "feature"])
    sev = F.sum(F.col("is_severe").cast("int")).over(Window.partitionBy(*g))
    return out.withColumn("severe_count", sev.cast("bigint"))
