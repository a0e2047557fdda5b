"""ARIMA(1,1,1) by conditional sum of squares, forecasts and diagnostics
(ML-23 … ML-25, TS-16, TS-19).

The close is densified to a calendar grid and forward filled (TS-16), then
differenced.  The CSS residual recursion ``e_t = d_t − φ d_(t−1) − θ e_(t−1)``
(``e`` starts at 0 after the first difference) is an affine map of the residual
before, so it is scanned in two levels: a series is cut into blocks of ``BLOCK``
levels (with two levels of the block before, for the first difference and its
lag), every block is filtered from a zero start next to its own powers of −θ,
and the starts are carried from block to block over those summaries.  A long
series is therefore spread over as many tasks as it has blocks; only summaries
are shuffled, never the series.

For a given θ the residual is linear in φ, so a grid of (φ, θ) needs one pass per
θ: θ is exploded next to a block inside the same task, and the best point per
ticker is a partial ``min``.  Two finer grids around the best point refine it
(steps 0.05 → 0.005 → 0.0005).
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickwise.operators.timeseries import forecast_dates, infer_frequency
from tickwise.session import materialize


#: Levels of a block of the scan.
BLOCK = 4096


def regrid(series: DataFrame, value: str = "Close", part: str = "ticker") -> DataFrame:
    """TS-16 + TS-17: re-grid each ticker at its inferred frequency (D: every
    day, B: weekdays, W: every 7 days from the first date), forward fill and
    number the grid (``t``); rows off the grid are dropped, as ``asfreq`` does."""
    s = series.select(part, "date", value)
    span = (s.groupBy(part).agg(F.min("date").alias("d0"), F.max("date").alias("d1"))
            .join(infer_frequency(s, part).select(part, "freq"), part))
    step = F.when(F.col("freq") == "W", 7).otherwise(1)
    offs = F.sequence(F.lit(0), F.datediff("d1", "d0"), step)
    grid = span.select(part, "freq", F.explode(F.transform(offs, lambda o: F.date_add("d0", o))).alias("date"))
    grid = grid.where((F.col("freq") != "B") | ~F.dayofweek("date").isin(1, 7))
    j = grid.join(s, [part, "date"], "left")
    w = Window.partitionBy(part).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return j.select(part, "date", "freq", F.last(F.col(value), ignorenulls=True).over(w).alias(value),
                    (F.row_number().over(w) - 1).cast("bigint").alias("t"))


def series_blocks(levels: DataFrame, block: int = BLOCK, part: str = "ticker", at: str = "t", value: str = "v") -> DataFrame:
    """``(part, block, pd, d)``: the differences of each block in order and the one before its first.

    Few bytes hold much work here, so blocks are dealt over a task each, up to
    ``spark.sql.shuffle.partitions``, whatever their size.

    ``levels`` has a row per position ``at`` = 0, 1, 2 …; the last two levels
    of a block also go to the next one.  Block 0 begins at the second
    difference, where the recursion does.
    """
    if block < 3:
        raise ValueError("a block needs three levels")
    t = F.col(at)
    own = F.floor(t / block)
    both = F.when(t % block >= block - 2, F.array(own, own + 1)).otherwise(F.array(own))
    rows = levels.select(part, F.explode(both).alias("block"), F.struct(t.alias("t"), F.col(value).alias("v")).alias("x"))
    spark = levels.sparkSession
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(spark.sparkContext.defaultParallelism, -(-levels.count() // block)))
    rows = rows.repartition(tasks, part, "block")
    runs = rows.groupBy(part, "block").agg(F.sort_array(F.collect_list("x")).alias("x"))  # at most block + 2 levels
    runs = runs.where(F.element_at("x", -1)["t"] >= F.col("block") * block)  # no block of nothing but borrowed levels
    v = F.transform("x", lambda r: r["v"])
    diffs = F.transform(F.slice(v, 2, F.greatest(F.size(v) - 1, F.lit(0))), lambda x, i: x - F.get(v, i))
    return runs.select(part, "block", diffs.alias("x")).select(
        part, "block", F.get("x", F.lit(0)).alias("pd"), F.slice("x", 2, F.greatest(F.size("x") - 1, F.lit(0))).alias("d"))


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def css_block(d: str, before: str, theta: str, first: str) -> Column:
    """A block's summary for one θ: the filters a_t = d_t − θ a_(t−1) and b_t = d_(t−1) − θ b_(t−1) from a zero
    start (ends ``a``, ``b``), the power of −θ (``p``), and the sums of all their products.  A ``first`` block does
    start at zero and needs no powers.  Arguments are column names."""
    every = ("aa", "ab", "bb", "ap", "bp", "pp")
    now = {"a": f"(x - {theta} * acc.a)", "b": f"(acc.pd - {theta} * acc.b)", "p": f"(-{theta} * acc.p)"}

    def run(states: str, sums: tuple) -> str:
        init = {"pd": before, **{c: "1D" if c == "p" else "0D" for c in states}, **{c: "0D" for c in sums}}
        step = {"pd": "x", **{c: now[c] for c in states}, **{c: f"acc.{c} + {now[c[0]]} * {now[c[1]]}" for c in sums}}
        out = {c: f"acc.{c}" if c in step else "0D" for c in ("a", "b", "p", *every)}
        return f"aggregate({d}, {_struct(init)}, (acc, x) -> {_struct(step)}, acc -> {_struct(out)})"
    return F.expr(f"CASE WHEN {first} THEN {run('ab', every[:3])} ELSE {run('abp', every)} END")


def carried_sums(blocks: str) -> Column:
    """Σa², Σab and Σb² of the whole series from its blocks' summaries (``s``) in order."""
    step = {"a": "x.s.a + x.s.p * acc.a", "b": "x.s.b + x.s.p * acc.b",
            "aa": "acc.aa + x.s.aa + 2D * acc.a * x.s.ap + acc.a * acc.a * x.s.pp",
            "ab": "acc.ab + x.s.ab + acc.a * x.s.bp + acc.b * x.s.ap + acc.a * acc.b * x.s.pp",
            "bb": "acc.bb + x.s.bb + 2D * acc.b * x.s.bp + acc.b * acc.b * x.s.pp"}
    return F.expr(f"aggregate({blocks}, {_struct(dict.fromkeys(step, '0D'))}, (acc, x) -> {_struct(step)})")


def css_state(d: str, before: str, start: str, phi: str = "phi", theta: str = "theta") -> Column:
    """A block's last difference and residual, Σe² and Σ|e|, from the residual before it, and the power of −θ."""
    e = f"(x - {phi} * acc.pd - {theta} * acc.pe)"
    init = {"pd": before, "pe": start, "s": "0D", "a": "0D", "p": "1D"}
    step = {"pd": "x", "pe": e, "s": f"acc.s + {e} * {e}", "a": f"acc.a + abs({e})", "p": f"-{theta} * acc.p"}
    return F.expr(f"aggregate({d}, {_struct(init)}, (acc, x) -> {_struct(step)})")


def _grid_search(blocks: DataFrame, part: str, center_phi: str, center_theta: str, half: int, denom: float) -> DataFrame:
    """The (φ, θ) of least Σe² on the grid of ``2·half + 1`` steps of
    ``1/denom`` around the centre; only θ is exploded."""
    at = lambda center, i: f"({center} + CAST({i} - {half} AS DOUBLE) / {denom}D)"
    steps = f"sequence(0, {2 * half})"
    g = blocks.select("*", F.expr(f"explode({steps})").alias("_j")).withColumn("_theta", F.expr(at(center_theta, "_j")))
    g = g.where(F.abs("_theta") < 1).select(part, "_theta", F.expr(center_phi).alias("_phi0"), "block", css_block("d", "pd", "_theta", "block = 0").alias("s"))
    # a series' summaries: a row of numbers per block and theta
    whole = g.groupBy(part, "_theta", "_phi0").agg(F.sort_array(F.collect_list(F.struct("block", "s"))).alias("_b"))
    whole = whole.select(part, "_theta", "_phi0", carried_sums("_b").alias("_s"))
    point = _struct({"_sse": "_s.aa - 2D * p * _s.ab + p * p * _s.bb", "_phi": "p", "_theta": "_theta"})
    points = f"transform(filter(transform({steps}, i -> {at('_phi0', 'i')}), p -> abs(p) < 1), p -> {point})"
    best = whole.select(part, F.expr(f"array_min({points})").alias("_p")).groupBy(part).agg(F.min("_p").alias("_b"))
    return best.select(part, F.col("_b._phi").alias("phi"), F.col("_b._theta").alias("theta"))


def fit_levels(levels: DataFrame, block: int = BLOCK, part: str = "ticker", at: str = "t", value: str = "v") -> DataFrame:
    """CSS fit of every series of ``levels`` (a row per position 0, 1, 2 …):
    ``phi, theta, sse, sum_abs, n_resid, last_diff, last_resid``.  Series of
    fewer than three levels have no row."""
    d = materialize(series_blocks(levels, block, part, at, value).where(F.size("d") > 0))  # read by each refinement

    def beside(best: DataFrame) -> DataFrame:
        # by the names of the blocks, so that a long series' blocks aren't brought together for a row of two numbers
        return d.join(d.select(part, "block").join(best, part), [part, "block"])

    b1 = _grid_search(d, part, "0D", "0D", 19, 20.0)
    b2 = _grid_search(beside(b1), part, "phi", "theta", 10, 200.0)
    b3 = _grid_search(beside(b2), part, "phi", "theta", 10, 2000.0)
    fit = materialize(beside(b3))
    # the residual before each block: block ends from a zero start, carried on by the powers of -theta
    zero = fit.select(part, "block", css_state("d", "pd", "0D").alias("s"))
    ends = zero.groupBy(part).agg(F.sort_array(F.collect_list(F.struct("block", "s.pe", "s.p"))).alias("b"))
    starts = F.expr("""inline(aggregate(b, named_struct('e', 0D, 'out', CAST(array() AS array<struct<block: bigint, start: double>>)),
        (acc, x) -> named_struct('e', x.pe + x.p * acc.e, 'out', array_append(acc.out, named_struct('block', x.block, 'start', acc.e))), acc -> acc.out))""")
    starts = ends.select(part, starts)
    run = fit.join(starts, [part, "block"]).select(part, "phi", "theta", "block", F.size("d").alias("n"),
                                                   css_state("d", "pd", "start").alias("s"))
    return run.groupBy(part, "phi", "theta").agg(F.sum("s.s").alias("sse"), F.sum("s.a").alias("sum_abs"), F.sum("n").alias("n_resid"),
                                                 F.max_by("s.pd", "block").alias("last_diff"), F.max_by("s.pe", "block").alias("last_resid"))


def fit_arima(series: DataFrame, value: str = "Close", part: str = "ticker", block: int = BLOCK) -> DataFrame:
    """ML-23 + ML-25: CSS fit of ARIMA(1,1,1) without constant per ticker,
    with σ², log-likelihood, AIC/BIC (k = 3), residual RMSE/MAE, last
    observation and the recursion's end state for forecasting.  Tickers of
    fewer than three grid levels have a row with status ``skipped`` and no fit."""
    dense = materialize(regrid(series, value, part))
    levels = dense.select(part, "t", F.col(value).alias("v"))
    info = dense.groupBy(part, "freq").agg(F.max("date").alias("last_date"), F.max_by(value, "t").alias("last_obs"), F.count(F.lit(1)).alias("n_levels"))
    fit = info.join(fit_levels(levels, block, part), part, "left")
    n = F.col("n_resid").cast("double")
    sse = F.col("sse")
    sigma2 = sse / n
    ll = -n / 2.0 * (F.log(F.lit(2 * math.pi) * sigma2) + 1.0)
    return fit.select(
        part, "phi", "theta", sigma2.alias("sigma2"), "sse", F.col("n_resid").cast("bigint"),
        ll.alias("log_likelihood"), (-2.0 * ll + 6.0).alias("aic"), (-2.0 * ll + 3.0 * F.log(n)).alias("bic"),
        F.sqrt(sigma2).alias("rmse"), (F.col("sum_abs") / n).alias("mae"), "last_obs", "last_date", "freq",
        "last_diff", "last_resid", F.when(F.col("n_levels") < 3, "skipped").otherwise("ok").alias("status"))


def forecast(fit: DataFrame, horizon: int = 7, z: float = 1.96, part: str = "ticker") -> DataFrame:
    """ML-24 + TS-19: h-step level forecasts with 95 % intervals.

    ``d̂₁ = φ d_n + θ e_n``, ``d̂_j = φ^(j−1) d̂₁``; level = last + Σ d̂.  The
    error variance uses the integrated MA weights ``Ψ_0 = 1``,
    ``Ψ_j = 1 + (φ+θ)(1−φ^j)/(1−φ)``: half width ``z σ √Σ_(j<h) Ψ_j²``.
    """
    if "status" in fit.columns:  # a skipped ticker has no forecast
        fit = fit.where(F.col("status") == "ok")
    phi, theta = F.col("phi"), F.col("theta")
    d1 = phi * F.col("last_diff") + theta * F.col("last_resid")
    steps = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    h = F.col("step")

    def psi(j):
        return F.when(j == 0, F.lit(1.0)).otherwise(
            F.lit(1.0) + (phi + theta) * (F.lit(1.0) - F.pow(phi, j)) / (F.lit(1.0) - phi))
    level = F.col("last_obs") + d1 * (F.lit(1.0) - F.pow(phi, h)) / (F.lit(1.0) - phi)
    var = F.aggregate(F.sequence(F.lit(0), h - 1), F.lit(0.0), lambda s, j: s + psi(j) * psi(j))
    half = F.lit(z) * F.sqrt(F.col("sigma2")) * F.sqrt(var)
    freq = F.col("freq") if "freq" in fit.columns else F.lit("D")
    dates = forecast_dates(F.col("last_date"), horizon, freq)
    return steps.select(part, h.cast("bigint").alias("step"),
                        F.element_at(dates, h.cast("int")).alias("date"),
                        level.alias("prediction"), (level - half).alias("lower"), (level + half).alias("upper"))
