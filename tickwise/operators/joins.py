"""Join helpers (JN-01 … JN-07).

Joins carry no broadcast hints: the planner and AQE choose by measured bytes
and split skewed keys.  A stated set of query rows is joined to all rows in
blocks (``query_blocks``), a keyed join without any row limit.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickwise.functions.exprs import running_total
from tickwise.session import materialize


def query_blocks(rows: DataFrame, queries: DataFrame, block: int = 256) -> DataFrame:
    """Every row beside every block of ``queries``: the column ``queries`` holds
    up to ``block`` query rows as an array of structs.

    Query rows are numbered by a hash into as many blocks as their count asks
    for; ``rows`` gets one copy per block and meets it in a join on its number.
    """
    n = -(-queries.count() // block) or 1
    cols = F.struct(*queries.columns)
    blocks = (queries.select(F.pmod(F.xxhash64(*queries.columns), F.lit(n)).cast("int").alias("_block"), cols.alias("_q"))
              .groupBy("_block").agg(F.collect_list("_q").alias("queries")))  # about ``block`` rows each
    copies = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.join(blocks, "_block").drop("_block")


def join_on_position(left: DataFrame, right: DataFrame, row_id: str = "row_id",
                     part: str = "ticker") -> DataFrame:
    """JN-02: join on a stored row position (``_metadata.row_index`` for
    Parquet files, or an ingest sequence)."""
    return left.join(right, [part, row_id])


def with_position(rows: DataFrame, name: str = "position") -> DataFrame:
    """JN-02: ``rows``, read from Parquet files, with each row's place in the whole table, files in the order of their names.

    A file's rows are counted without their columns, the counts are summed up
    before each file (a row per file), and a row's place is that sum plus its
    index in its file.
    """
    named = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    sizes = materialize(named.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")))
    return named.join(running_total(sizes, "_file", "_n", "_before"), "_file").withColumn(name, F.col("_before") + F.col("_index")).drop("_file", "_index", "_before")


def join_by_position(left: DataFrame, right: DataFrame) -> DataFrame:
    """JN-02: row i of one table beside row i of another, however either is split into files; ``right``'s names must differ."""
    return with_position(left).join(with_position(right), "position")


def tail_align(left: DataFrame, right: DataFrame, part: str = "ticker", order: str = "date") -> DataFrame:
    """JN-03: pair the last rows of both sides by position from the end."""
    def pos(df):
        w = Window.partitionBy(part).orderBy(F.col(order).desc())
        return df.withColumn("_pos_from_end", F.row_number().over(w))
    r = pos(right)
    r = r.select(part, "_pos_from_end", *[F.col(c).alias(f"r_{c}") for c in right.columns if c != part])
    return pos(left).join(r, [part, "_pos_from_end"])


def shared_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """JN-06: columns present in both tables, in ``b``'s order."""
    have = set(a.columns)
    return [c for c in b.columns if c in have]


def groups_without(current: DataFrame, baseline: DataFrame, key: str = "ticker") -> DataFrame:
    """JN-07: keys of ``current`` with no row in ``baseline``."""
    return current.select(key).distinct().join(baseline.select(key).distinct(), key, "left_anti")
