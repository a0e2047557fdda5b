"""Nearest-neighbour look-ups (ML-26, ML-27, TK-04, JN-04, AG-15 … AG-17).

Targets (a handful per group) are joined to every candidate row of their
group; without a group they are a stated query set and meet the rows in
blocks.  For repeated look-ups in one large table there is a stored index
(``pivot_index``).  The distance is a native array expression.  Top-k is two-level: a first cut keeps the best
``k`` per (group, target, hash bucket) so no window ever holds a whole
group, then the final ``k`` are ranked over at most ``k × buckets`` rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickwise.operators.cluster import distance
from tickwise.operators.joins import query_blocks
from tickwise.operators.metrics import value_summary
from tickwise.session import materialize


def _g(group):
    return [group] if isinstance(group, str) else list(group or [])


def newest_targets(points: DataFrame, vec: str, group=("ticker",), date: str | None = None) -> DataFrame:
    """ML-26 target choice: the row of ``date`` when present, else the newest
    row of each group."""
    g = _g(group)
    p = points
    if date is not None:
        hit = p.where(F.col("date") == F.lit(date).cast("date"))
        have = hit.select(*g).distinct()
        rest = p.join(have, g, "left_anti")
        newest = rest.groupBy(*g).agg(F.max_by(F.struct("date", vec), "date").alias("_t")).select(*g, "_t.*")
        return hit.select(*g, "date", vec).unionByName(newest)
    return p.groupBy(*g).agg(F.max_by(F.struct("date", vec), "date").alias("_t")).select(*g, "_t.*")


def knn(points: DataFrame, targets: DataFrame, vec: str, k: int = 10, group=("ticker",),
        key: str = "date", exclude_self: bool = True, buckets: int = 64) -> DataFrame:
    """TK-04 / ML-26 / ML-27: the ``k`` nearest candidate rows of every
    target (ties by key).  ``targets`` holds (group, key, vec); the output is
    (group, target key, rank, neighbour key, distance)."""
    g = _g(group)
    if g:
        t = targets.select(*g, F.col(key).alias("target"), F.col(vec).alias("_t"))
        j = points.select(*g, key, vec).join(t, g)
    else:
        t = targets.select(F.col(key).alias("target"), F.col(vec).alias("_t"))
        j = query_blocks(points.select(key, vec), t).select(key, vec, F.explode("queries").alias("_tt")).select(key, vec, "_tt.*")
    if exclude_self:
        j = j.where(F.col(key) != F.col("target"))
    return nearest_rows(j.select(*g, "target", key, distance(F.col(vec), F.col("_t")).alias("distance")), [*g, "target"], key, k, buckets)


def nearest_rows(j: DataFrame, by: list[str], key: str, k: int, buckets: int = 64) -> DataFrame:
    """TK-04: the ``k`` rows of least ``distance`` per ``by`` (ties by key) with their ``rank``, first inside hash buckets."""
    j = j.withColumn("_b", F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)))
    order = [F.col("distance").asc(), F.col(key).asc()]
    first = j.withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_b").orderBy(*order)))
    first = first.where(F.col("_r") <= k).drop("_r", "_b")
    out = first.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return out.where(F.col("rank") <= k)


def neighbour_summary(neigh: DataFrame, value: str, group=("ticker", "target")) -> DataFrame:
    """AG-15 + AG-16 over the neighbours' values (population std)."""
    return value_summary(neigh, value, group)


def recommend(points: DataFrame, targets: DataFrame, vec: str, next_values: DataFrame, k: int = 5, group=("ticker",),
              exclude_self: bool = True, value: str = "next_return") -> DataFrame:
    """ML-26 / ML-27 in full: the neighbours of every target with their
    ``next_values`` columns (JN-04, NULL where a row has none) and the mean,
    median and population std of ``value`` over them (AG-15).  ML-27 keeps the
    target's own row: its raw vector may be a day's, but no day is named."""
    g = _g(group)
    nb = knn(points, targets, vec, k, group, exclude_self=exclude_self).join(next_values, [*g, "date"], "left")
    nb = materialize(nb)  # k rows a target, read for the list and for the summary
    stats = neighbour_summary(nb, value, [*g, "target"]).select(*g, "target", *[F.col(c).alias(f"{c}_{value}") for c in ("mean", "median", "std")])
    return nb.join(stats, [*g, "target"], "left")
