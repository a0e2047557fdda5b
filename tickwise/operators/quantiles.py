"""Exact quantiles of all groups at once by rank selection (AG-13).

``percentile`` keeps every distinct value of a group in one buffer, which a hot
group outgrows.  Here a round counts the rows between cuts taken from a
bounded sketch, finds the interval that holds the wanted ranks and goes on
with that interval alone.  A sketch only proposes cuts; ranks come from exact
counts, so its error costs rounds, never the result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickwise.session import materialize

#: Cuts of a round: an interval is this many times narrower than the last one.
CUTS = 256
#: Groups of up to this many rows keep their values in one buffer.
GROUP_ROWS = 100_000


def _select(rows: DataFrame, wanted: DataFrame, g: list[str], cuts: int) -> DataFrame:
    """``(*g, _k, _v)``: the value of each wanted rank ``_k`` (from 0); ``rows`` hold ``_v``, no nulls."""
    found = None
    # the interval of a rank: rows of values above _lo and below _hi (null: open), _base rows stand before it
    state = materialize(wanted.select(*g, "_k", F.lit(0).cast("bigint").alias("_base"), F.lit(None).cast("double").alias("_lo"),
                                      F.lit(None).cast("double").alias("_hi")))
    while True:
        inside = F.coalesce(F.col("_v") > F.col("_lo"), F.lit(True)) & F.coalesce(F.col("_v") < F.col("_hi"), F.lit(True))
        live = rows.join(state, g).where(inside)
        steps = [i / cuts for i in range(cuts + 1)]
        marks = live.groupBy(*g, "_k").agg(F.array_distinct(F.percentile_approx("_v", steps, 20 * cuts)).alias("_cuts"))
        below = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
        # a cut's own rows have a bucket of their own: it is a single value, and each interval excludes its cuts
        bucket = 2 * below + F.array_contains("_cuts", F.col("_v")).cast("int")
        counts = (live.join(marks, [*g, "_k"]).groupBy(*g, "_k", bucket.alias("_b"))
                  .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most")))
        order = Window.partitionBy(*g, "_k").orderBy("_b")  # 2 cuts + 3 rows at most
        placed = counts.withColumn("_upto", F.sum("_c").over(order)).join(state.select(*g, "_k", "_base", "_lo", "_hi"), [*g, "_k"])
        placed = placed.join(marks, [*g, "_k"])
        place = F.col("_k") - F.col("_base")
        hit = placed.where((place < F.col("_upto")) & (place >= F.col("_upto") - F.col("_c")))
        at = F.floor(F.col("_b") / 2).cast("int")
        hit = materialize(hit.select(
            *g, "_k", (F.col("_base") + F.col("_upto") - F.col("_c")).alias("_base"), "_least", "_most",
            F.coalesce(F.when(at > 0, F.get("_cuts", at - 1)), F.col("_lo")).alias("_lo"), F.coalesce(F.get("_cuts", at), F.col("_hi")).alias("_hi")))
        done = hit.where(F.col("_least") == F.col("_most")).select(*g, "_k", F.col("_least").alias("_v"))
        found = done if found is None else found.unionByName(done)
        state = hit.where(F.col("_least") != F.col("_most")).select(*g, "_k", "_base", "_lo", "_hi")
        if state.isEmpty():
            return found


def exact_quantile(df: DataFrame, value: str | Column, q: float, group=("ticker",), name: str = "quantile",
                   group_rows: int = GROUP_ROWS, cuts: int = CUTS) -> DataFrame:
    """``(*group, name)``: the quantile with linear interpolation between the two nearest ranks.

    Nulls do not count; a group of nulls only has a null; NaN is the greatest
    value.  Groups of more than ``group_rows`` rows are narrowed by counted
    intervals, the others take Spark's own exact percentile; both give the
    same.  A null group key is a group.
    """
    g = [group] if isinstance(group, str) else list(group)
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = materialize(df.select(*g, v.alias("_v")))  # narrow, read a few times
    by = g or [F.lit("").alias("_g")]
    if rows.groupBy(*by).agg(F.count("_v").alias("_n")).where(F.col("_n") > group_rows).isEmpty():
        return rows.groupBy(*by).agg(F.percentile("_v", q).alias(name)).select(*g, name)
    # a null key joins as a flag and a value
    safe = [F.struct(F.col(c).isNull().alias("n"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("v")) for c in g]
    key = F.to_json(F.struct(*[s.alias(f"c{i}") for i, s in enumerate(safe)])) if g else F.lit("")
    rows = rows.select(*g, key.alias("_g"), "_v")
    sizes = materialize(rows.groupBy("_g").agg(F.count("_v").alias("_n"), *[F.first(c).alias(c) for c in g]))
    large = sizes.where(F.col("_n") > group_rows)
    small = rows.join(sizes.where(F.col("_n") <= group_rows).select("_g"), "_g").groupBy("_g").agg(F.percentile("_v", q).alias(name))
    if not large.isEmpty():
        at = F.lit(float(q)) * (F.col("_n") - 1)
        ends = large.select("_g", at.alias("_at"), F.floor(at).alias("_low"), F.ceil(at).alias("_high"))
        wanted = ends.select("_g", F.explode(F.array_distinct(F.array("_low", "_high"))).alias("_k"))
        held = rows.where(F.col("_v").isNotNull()).select("_g", "_v")
        got = _select(held, wanted, ["_g"], cuts)
        low, high = (got.select("_g", F.col("_k").alias(k), F.col("_v").alias(x)) for k, x in (("_low", "_a"), ("_high", "_z")))
        mixed = F.when(F.col("_low") == F.col("_high"), F.col("_a")).otherwise(
            (F.col("_high") - F.col("_at")) * F.col("_a") + (F.col("_at") - F.col("_low")) * F.col("_z"))
        small = small.unionByName(ends.join(low, ["_g", "_low"]).join(high, ["_g", "_high"]).select("_g", mixed.alias(name)))
    return sizes.join(small, "_g").select(*g, name)
