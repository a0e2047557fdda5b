"""TS-05: exponential moving average (``adjust=False``) as a blocked prefix scan.

Recursion: ``y_0 = x_0``, ``y_t = q·y_{t-1} + α·x_t`` with ``α = 2/(span+1)``,
``q = 1-α``.  Unrolled, ``y_t = Σ_i c_i q^(t-i)`` with ``c_0 = x_0`` and
``c_i = α·x_i``.  Rows of a ticker are cut into blocks of ``B`` rows
(``b = rn div B``, ``k = rn mod B``):

* inside a block: ``local = q^k · Σ_{j<=k} c_j q^(-j)`` — a running sum
  (window over ``(ticker, b)``); exponents stay below ``B`` so nothing
  overflows;
* every earlier block ``b-j`` contributes its end value (the in-block value
  at ``k = B-1``, ``E_(b-j) = Σ c_i q^(B-1-k_i)``) scaled by ``q^(k+1+(j-1)B)``.  ``E_(b-j)`` is
  a RANGE frame ``[-j, -j]`` over the block number, so no join and no extra
  shuffle is needed.  Only ``J`` blocks are visited, with ``q^(J·B) < 1e-20``.

Everything is a built-in window aggregate: no Python, no recursion, no
collect.  All windows share the ``ticker`` hash partitioning of the caller.
"""
from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

BLOCK = 128
_TABLES: dict = {}


def blocks_needed(span: float, block: int = BLOCK) -> int:
    q = 1.0 - 2.0 / (span + 1.0)
    if q <= 0.0:
        return 1
    return max(1, math.ceil(46.0 / (block * -math.log(q))))


def powers(spark: SparkSession, q: float, k: Column, block: int, shift: int = 0, sign: int = 1) -> Column:
    """``q^(sign·k + shift)`` of ``k`` from 0 to ``block`` - 1, looked up among Spark's own powers, which are taken once and not per row."""
    at = (q, block, shift, sign)
    if at not in _TABLES:
        row = spark.sql(f"SELECT transform(sequence(0, {block - 1}), k -> pow({q!r}D, {sign} * k + {shift}))").first()
        _TABLES[at] = np.array(row[0], dtype="float64")
    return F.get(F.lit(_TABLES[at]), k)


def add_row_number(df: DataFrame, part: str = "ticker", order: str = "date",
                   rn: str = "_rn") -> DataFrame:
    w = Window.partitionBy(part).orderBy(order)
    return df.withColumn(rn, (F.row_number().over(w) - 1).cast("long"))


def ema(df: DataFrame, specs: dict[str, tuple[str, float]], part: str = "ticker",
        order: str = "date", rn: str = "_rn", block: int = BLOCK,
        keep_blocks: bool = False) -> DataFrame:
    """Add one EMA column per ``out -> (input column, span)``.

    Inputs must be non-null (the bar builder guarantees a close per row).
    ``rn`` (0-based row number per ``part``) is computed when absent.  With
    ``keep_blocks`` the block columns stay, so a following EMA pass (e.g. the
    MACD signal) reuses them and the data's existing sort order.
    """
    if rn not in df.columns:
        df = add_row_number(df, part, order, rn)
    spark = df.sparkSession
    r = F.col(rn)
    if "_b" not in df.columns:
        b = F.floor(r / block)
        df = df.withColumn("_b", b).withColumn("_k", (r - b * block).cast("int"))
    kk = F.col("_k")
    w_in = (Window.partitionBy(part, "_b").orderBy(rn)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_blk = Window.partitionBy(part).orderBy("_b")

    stage1, stage2, stage3 = [], [], []
    last = kk == F.lit(block - 1)
    for out, (x, span) in specs.items():
        if span <= 1:
            continue
        alpha = 2.0 / (span + 1.0)
        q = 1.0 - alpha
        c = F.when(r == 0, F.col(x)).otherwise(F.lit(alpha) * F.col(x))
        stage1.append(F.sum(c * powers(spark, q, kk, block, sign=-1)).over(w_in).alias(f"{out}__s"))
    df = df.select("*", *stage1)
    # The block end value is the in-block value at k = B-1.  Deriving it from
    # the running sum keeps the (ticker, b, rn) sort of the previous window
    # for the range frames below (no second sort).
    for out, (x, span) in specs.items():
        if span <= 1:
            continue
        q = 1.0 - 2.0 / (span + 1.0)
        loc = powers(spark, q, kk, block) * F.col(f"{out}__s")
        stage2.append(loc.alias(f"{out}__l"))
        stage2.append(F.when(last, loc).alias(f"{out}__e"))
    df = df.select("*", *stage2)
    for out, (x, span) in specs.items():
        if span <= 1:
            stage3.append(F.col(x).alias(out))
            continue
        q = 1.0 - 2.0 / (span + 1.0)
        y = F.col(f"{out}__l")
        for j in range(1, blocks_needed(span, block) + 1):
            ej = F.sum(f"{out}__e").over(w_blk.rangeBetween(-j, -j))
            y = y + powers(spark, q, kk, block, 1 + (j - 1) * block) * F.coalesce(ej, F.lit(0.0))
        stage3.append(y.alias(out))
    df = df.select("*", *stage3)
    drop = [c for c in df.columns if c[-3:] in ("__s", "__e", "__l")]
    if not keep_blocks:
        drop += ["_b", "_k"]
    return df.drop(*drop)
