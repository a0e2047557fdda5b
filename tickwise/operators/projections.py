"""Projections, filters and predicates (PRJ-01 … PRJ-15).

Column choices are made at plan time from ``df.schema`` (never by looking at
data), so every operator here is a single ``select`` / ``where`` that
Catalyst pushes into the scan where possible.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tickwise.functions.exprs import finite


def numeric_columns(df: DataFrame, exclude=("date", "ticker")) -> list[str]:
    """PRJ-01: numeric fields of the schema minus exclusions, in order."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def finite_only(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PRJ-02: ±inf and NaN → NULL in numeric double columns (one select)."""
    cols = set(cols or [f.name for f in df.schema.fields
                        if isinstance(f.dataType, (T.DoubleType, T.FloatType))])
    return df.select(*[finite(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def complete_cases(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PRJ-03 / PRJ-04: drop rows with a NULL (or NaN) in ``cols`` (all by default)."""
    return df.na.drop(subset=cols) if cols else df.na.drop()


def constant_columns(df: DataFrame, cols: list[str], part: str = "ticker") -> DataFrame:
    """PRJ-05: per ticker and column, whether the column is constant
    (distinct values incl. NULL ≤ 1).  One aggregate per ticker, whose single
    row is unpivoted: the rows themselves are not multiplied by the columns."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [F.min(v).alias(f"_mn{i}"), F.max(v).alias(f"_mx{i}"), F.count(v).alias(f"_n{i}")]
    agg = df.groupBy(part).agg(F.count(F.lit(1)).alias("_n"), *aggs)
    flags = []
    for i, c in enumerate(cols):
        varying = (F.col(f"_mn{i}") != F.col(f"_mx{i}")) | ((F.col(f"_n{i}") > 0) & (F.col(f"_n{i}") < F.col("_n")))
        flags.append(F.struct(F.lit(c).alias("feature"), (~F.coalesce(varying, F.lit(False))).alias("is_constant")))
    return agg.select(part, F.inline(F.array(*flags)))


def drop_constant_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """PRJ-05 for one table: the kept column names, in order.  Min, max and
    counts of every column come from one aggregate job (one small row)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__mn"), F.max(c).alias(f"{c}__mx"), F.count(c).alias(f"{c}__n")]
    row = df.agg(F.count(F.lit(1)).alias("__n"), *aggs).first()
    keep = []
    for c in cols:
        mn, mx, n = row[f"{c}__mn"], row[f"{c}__mx"], row[f"{c}__n"]
        if (mn != mx) or (0 < n < row["__n"]):
            keep.append(c)
    return keep


def log_volume(c: Column) -> Column:
    """PRJ-06: numeric coercion (bad → 0) then ``log1p``."""
    return F.log1p(F.coalesce(c.try_cast("double"), F.lit(0.0)))


def impute(df: DataFrame, cols: list[str], part: str = "ticker", order: str = "date") -> DataFrame:
    """PRJ-07: forward fill, then backward fill, then 0.  A value both fills
    miss has no value in its ticker at all, so its median is missing too.  The
    backward fill runs forward over the reversed order: one pass, not one per row."""
    w = Window.partitionBy(part).orderBy(order)
    fwd = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bwd = Window.partitionBy(part).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = []
    for c in cols:
        v = F.col(c)
        out.append(F.coalesce(F.last(v, True).over(fwd), F.last(v, True).over(bwd), F.lit(0.0)).alias(c))
    return df.select(*[F.col(c) for c in df.columns if c not in cols], *out)


def date_range(df: DataFrame, since: str | None = None, until: str | None = None,
               col: str = "date") -> DataFrame:
    """PRJ-08: inclusive bounds; an unparsable bound is ignored.  Bounds are
    parsed once on the driver so the filter is a literal comparison that
    reaches the Parquet scan."""
    import datetime as _dt

    def parse(s):
        try:
            return _dt.date.fromisoformat(str(s).strip()[:10]) if s else None
        except ValueError:
            return None
    lo, hi = parse(since), parse(until)
    if lo:
        df = df.where(F.col(col) >= F.lit(lo))
    if hi:
        df = df.where(F.col(col) <= F.lit(hi))
    return df


def parse_dates(df: DataFrame, col: str, out: str = "date") -> DataFrame:
    """PRJ-09: parse text to a date; unparsable → NULL → row dropped."""
    return df.withColumn(out, F.to_date(F.try_to_timestamp(F.col(col)))).where(F.col(out).isNotNull())


def align_to_features(df: DataFrame, names: list[str]) -> DataFrame:
    """PRJ-10: map model feature names to columns — exact, stripped, or the
    first token before a space; order fixed; missing names raise."""
    cols = {c: c for c in df.columns}
    stripped = {c.strip(): c for c in df.columns}
    first_tok = {c.split(" ")[0]: c for c in df.columns}
    sel, missing = [], []
    for n in names:
        src = cols.get(n) or stripped.get(n.strip()) or first_tok.get(n.split(" ")[0])
        if src is None:
            missing.append(n)
        else:
            sel.append(F.col(f"`{src}`").alias(n))
    if missing:
        raise ValueError(f"missing features: {missing}")
    return df.select(*sel)


def with_missing_as_null(df: DataFrame, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """PRJ-11: absent expected columns become NULL double columns."""
    have = set(df.columns)
    return df.select(*(keep or []), *[F.col(n) if n in have else F.lit(None).cast("double").alias(n)
                                      for n in names])


def latest_row(df: DataFrame, part: str = "ticker", order: str = "date") -> DataFrame:
    """PRJ-12: newest row per ticker with ``max_by`` (no sort, no window)."""
    others = [c for c in df.columns if c != part]
    return (df.groupBy(part).agg(F.max_by(F.struct(*others), F.col(order)).alias("_r"))
            .select(part, "_r.*"))


def last_n_rows(df: DataFrame, n: int, part: str = "ticker", order: str = "date") -> DataFrame:
    """PRJ-13 / TK-08: the newest ``n`` rows of every ticker."""
    w = Window.partitionBy(part).orderBy(F.col(order).desc())
    return df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= n).drop("_rk")


def date_string(c: Column) -> Column:
    """PRJ-14: ``yyyy-MM-dd``."""
    return F.date_format(c, "yyyy-MM-dd")


def parse_vector(text: Column) -> Column:
    """PRJ-15: comma list → array<double>: trim, skip blanks, cast (bad → NULL)."""
    parts = F.filter(F.split(text, ","), lambda x: F.trim(x) != "")
    return F.transform(parts, lambda x: F.trim(x).try_cast("double"))
