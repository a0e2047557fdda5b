"""Scans of the driver's tables and of user files (SRC-01, SRC-02, SRC-04, SRC-06)."""
from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the test schema; Catalyst prunes columns / pushes filters."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def load_frame(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """SRC-01: Parquet, else CSV with a header, chosen by extension.  A missing
    path raises (Spark's AnalysisException: PATH_NOT_FOUND)."""
    if path.lower().endswith(".csv"):
        r = spark.read.option("header", True)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
        return r.csv(path)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def ticker_from_path(path_col: str = "_metadata.file_path") -> "F.Column":
    """SRC-04: upper-cased file stem (``.../aapl.parquet`` -> ``AAPL``)."""
    return F.upper(F.regexp_extract(F.col(path_col), r"([^/]+)\.[^./]+$", 1))


def load_ticker_files(spark: SparkSession, directory: str) -> DataFrame:
    """SRC-02 + SRC-04 + SRC-06: every per-ticker file of a folder in one scan.

    Parquet and CSV files are scanned once each (not one job per file), the
    ticker comes from the file name, zero-byte files are skipped, and both
    formats are combined by name.  A folder may hold one format only; one
    without any file of either raises.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory).select("path", "length")  # names alone are read
    kinds = {r.kind for r in files.where(F.col("length") > 0).select(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("kind")).distinct().collect()}
    frames = []
    if "parquet" in kinds:
        frames.append(spark.read.option("pathGlobFilter", "*.parquet").parquet(directory))
    if "csv" in kinds:
        frames.append(spark.read.option("header", True).option("inferSchema", True).option("pathGlobFilter", "*.csv").csv(directory))
    if not frames:
        raise FileNotFoundError(f"no Parquet or CSV file with rows in {directory}")
    named = [f.where(F.col("_metadata.file_size") > 0).withColumn("ticker", ticker_from_path()) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def normalise_columns(df: DataFrame, ticker: str | None = None) -> DataFrame:
    """SRC-05: vendor headers to the bar schema (``Date``→``date``,
    ``Adj Close``→``Adj_Close``), optional literal ticker."""
    ren = {}
    for c in df.columns:
        if c == "Date":
            ren[c] = "date"
        elif c == "Adj Close":
            ren[c] = "Adj_Close"
    out = df.withColumnsRenamed(ren) if ren else df
    if ticker is not None:
        out = out.withColumn("ticker", F.lit(ticker))
    return out


def resolve_ticker_rows(df: DataFrame, ticker: str, part: str = "ticker") -> DataFrame:
    """SRC-09: rows of ``ticker`` when it exists, else of the last ticker in
    sort order.  The choice is a scalar subquery (one value), so the filter
    is a plain equality that prunes partitions."""
    keys = df.select(part).distinct()
    exact = keys.where(F.col(part) == F.lit(ticker)).agg(F.max(part).alias("t"))
    fallback = keys.agg(F.max(part).alias("t"))
    target = F.coalesce(exact.scalar(), fallback.scalar())
    return df.where(F.col(part) == target)
