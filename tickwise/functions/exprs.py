"""Column-expression helpers shared by every operator (all JVM-side)."""
from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tickwise.session import materialize


def finite(c: Column) -> Column:
    """NaN and ±inf become NULL (PRJ-02 semantics for one column)."""
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None).cast("double")).otherwise(c)


def safe_div(a: Column, b: Column) -> Column:
    """Division that yields NULL for a zero or NULL divisor (ANSI-safe)."""
    return F.try_divide(a, b)


def rounded(c: Column, digits: int = 6) -> Column:
    """Round half up by plain IEEE arithmetic: ``floor(x*10^d + 0.5) / 10^d``.

    The same expression is written in the DuckDB oracles, so both engines
    produce identical doubles from identical inputs (no decimal tie rules).
    """
    s = float(10 ** digits)
    r = (F.floor(c * F.lit(s) + F.lit(0.5)) / F.lit(s)).cast("double")
    # non-finite and huge values pass through unchanged (both engines)
    return F.when(F.abs(c) < F.lit(1e15), r).otherwise(c.cast("double"))


def present(df: DataFrame, digits: int = 6, per_column: dict | None = None) -> DataFrame:
    """Final projection for reports: round doubles, widen ints to bigint."""
    per_column = per_column or {}
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = rounded(c.cast("double"), per_column.get(f.name, digits))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_round(expr: str, alias: str, digits: int = 6) -> str:
    """The DuckDB twin of ``rounded``."""
    s = repr(float(10 ** digits))
    return (f"CASE WHEN abs({expr}) < 1e15 THEN floor(({expr}) * {s} + 0.5) / {s} "
            f"ELSE CAST({expr} AS DOUBLE) END AS {alias}")


def running_total(rows: DataFrame, order: str, value: str, out: str, part_rows: int = 100_000) -> DataFrame:
    """``(order, out)``: the sum of ``value`` over the rows before, in the order of a unique column.

    Rows are sorted by range into parts; sums run inside a part and over the
    totals of the parts (a number a part), so no window holds the table.
    """
    parts = -(-rows.count() // part_rows) or 1
    split = rows.select(order, value).repartitionByRange(parts, order).withColumn("_p", F.spark_partition_id())
    split = materialize(split)
    totals = dict(split.groupBy("_p").agg(F.sum(value)).collect())
    before = [*accumulate([totals.get(p, 0) for p in range(parts)], initial=0)]
    starts = F.get(F.array(*[F.lit(b).cast("bigint") for b in before]), F.col("_p"))
    inside = F.sum(value).over(Window.partitionBy("_p").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return split.select(order, (starts + F.coalesce(inside, F.lit(0))).alias(out))
