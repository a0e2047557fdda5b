"""Stored pivot index for exact nearest neighbours (TK-04, ML-26, ML-27, JN-05).

Build: a few pivots are chosen far from each other out of a bounded sample;
every row gets its distances to them, belongs to its nearest pivot's cell and
is range-partitioned by (cell, distance to that pivot).  Each range is a shard:
a folder of the index with the smallest and largest distance to every pivot.

Search: |d(q, p) - d(x, p)| never exceeds d(q, x), so a shard whose distances
to some pivot all differ from the query's by more than the current k-th
distance holds no neighbour.  The shards nearest by that bound are read first
and give each query a k-th distance; of the others only those within it are
read (a partition filter, so skipped shards aren't opened), and in them the same
bound drops rows before their vectors are compared.  Results are exact; the
sample and the pivots only decide how much is skipped.
"""
from __future__ import annotations

import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tickwise.operators.cluster import distance
from tickwise.operators.joins import query_blocks
from tickwise.operators.neighbors import nearest_rows
from tickwise.session import materialize

#: Rows a shard should hold, pivots, and rows they are chosen from.
SHARD_ROWS, PIVOTS, SAMPLE = 250_000, 16, 2_000
#: Bounds are sums of rounded squares: a neighbour may miss its own bound by that share.
SLACK = 1e-9


def choose_pivots(points: DataFrame, vec: str, key: str, n: int = PIVOTS, sample: int = SAMPLE) -> list[list[float]]:
    """``n`` rows (fewer if fewer differ) of a hash-chosen sample, each the farthest from those before it."""
    rows = points.where(F.col(vec).isNotNull()).orderBy(F.xxhash64(key), key).limit(sample).select(F.col(vec).cast("array<double>")).collect()
    if not rows:
        return []
    x = np.array([r[0] for r in rows], float)
    far, out = np.full(len(x), np.inf), [0]
    while len(out) < n:
        far = np.minimum(far, ((x - x[out[-1]]) ** 2).sum(axis=1))
        if far.max() <= 0:
            break
        out.append(int(far.argmax()))
    return x[out].tolist()


def _to_pivots(vec: Column, pivots: list[list[float]]) -> Column:
    return F.array(*[distance(vec, F.lit(p)) for p in pivots]).cast("array<double>")


def build_index(points: DataFrame, path: str, key: str, vec: str, pivots: int = PIVOTS, shard_rows: int = SHARD_ROWS, sample: int = SAMPLE) -> None:
    """Write the index of ``points``' rows with a vector to ``path``: ``pivots``, ``rows`` by shard, and ``shards``."""
    spark = points.sparkSession
    chosen = choose_pivots(points, vec, key, pivots, sample)
    spark.createDataFrame(list(enumerate(chosen)), "pivot int, vec array<double>").coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "pivots"))
    rows = points.where(F.col(vec).isNotNull()).select(F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("vec"))
    shards = max(1, -(-rows.count() // shard_rows))
    rows = rows.withColumn("to_pivots", _to_pivots(F.col("vec"), chosen))
    near = F.array_min("to_pivots")
    rows = rows.repartitionByRange(shards, F.array_position("to_pivots", near), near, "key").withColumn("shard", F.spark_partition_id())
    out = rows.write.mode("overwrite")
    (out.partitionBy("shard") if chosen else out).parquet(os.path.join(path, "rows"))  # no row: a file that still names the columns
    written = spark.read.parquet(os.path.join(path, "rows"))
    each = range(len(chosen))
    stats = written.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.min(F.col("to_pivots")[i]) for i in each]).cast("array<double>").alias("low"),
                                         F.array(*[F.max(F.col("to_pivots")[i]) for i in each]).cast("array<double>").alias("high"))
    stats.write.mode("overwrite").parquet(os.path.join(path, "shards"))


def _bound(low: Column, high: Column, at: Column) -> Column:
    """The least distance that a row can have whose distances to the pivots lie in [low, high]."""
    gap = F.zip_with(F.zip_with(low, at, lambda a, q: a - q), F.zip_with(at, high, lambda q, b: q - b), lambda a, b: F.greatest(a, b, F.lit(0.0)))
    return F.array_max(gap)


def search(spark: SparkSession, path: str, queries: DataFrame, key: str, vec: str, k: int = 10, exclude_self: bool = True) -> tuple[DataFrame, DataFrame]:
    """The exact ``k`` nearest rows of every query row, and what was read for it.

    Returns ``(target, rank, key, distance)``, ties by key, and ``(target,
    n_shards, read_shards, n_rows, read_rows)``.  Queries without a vector have
    no neighbours; a query whose key is a row's key skips that row if
    ``exclude_self``.
    """
    pivots = [r.vec for r in spark.read.parquet(os.path.join(path, "pivots")).orderBy("pivot").collect()]
    q = queries.where(F.col(vec).isNotNull()).select(F.col(key).alias("target"), F.col(vec).cast("array<double>").alias("q"))
    q = materialize(q.withColumn("at", _to_pivots(F.col("q"), pivots)))
    shards = spark.read.parquet(os.path.join(path, "shards"))
    pairs = query_blocks(shards, q).select("shard", "n", "low", "high", F.explode("queries").alias("_q")).select("shard", "n", "low", "high", "_q.*")
    pairs = materialize(pairs.select("target", "q", "at", "shard", "n", _bound(F.col("low"), F.col("high"), F.col("at")).alias("bound")))
    # nearest shards first, until they hold k rows beside the query's own
    before = Window.partitionBy("target").orderBy("bound", "shard").rowsBetween(Window.unboundedPreceding, -1)
    pairs = pairs.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)) < k + int(exclude_self))

    def candidates(part: DataFrame, limit: Column | None = None) -> DataFrame:
        ids = [r.shard for r in part.select("shard").distinct().collect()]  # numbers of shards: a partition filter
        rows = spark.read.parquet(os.path.join(path, "rows")).where(F.col("shard").isin(ids)) if ids else spark.read.parquet(os.path.join(path, "rows")).where("false")
        met = rows.join(part, "shard")
        if exclude_self:
            met = met.where(F.col("key") != F.col("target"))
        if limit is not None:
            met = met.where(_bound(F.col("to_pivots"), F.col("to_pivots"), F.col("at")) <= limit)
        return nearest_rows(met.select("target", "key", distance(F.col("vec"), F.col("q")).alias("distance")), ["target"], "key", k)

    near = materialize(candidates(pairs.where("first")).drop("rank"))
    reach = near.groupBy("target").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance") * (1 + SLACK) + SLACK).otherwise(F.lit(float("inf"))).alias("reach"))
    rest = materialize(pairs.where(~F.col("first")).join(reach, "target").where(F.col("bound") <= F.col("reach")))
    found = nearest_rows(near.unionByName(candidates(rest, F.col("reach")).drop("rank")), ["target"], "key", k)
    seen = pairs.join(rest.select("target", "shard", F.lit(True).alias("_rest")), ["target", "shard"], "left")
    read = F.col("first") | F.coalesce("_rest", F.lit(False))
    visited = seen.groupBy("target").agg(F.count(F.lit(1)).alias("n_shards"), F.count_if(read).alias("read_shards"),
                                         F.sum("n").alias("n_rows"), F.sum(F.when(read, F.col("n")).otherwise(0)).alias("read_rows"))
    return found, visited
