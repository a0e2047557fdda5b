"""Sinks (SRC-07, SRC-08, SRC-12 … SRC-18).

All writes go to shared storage paths given by the caller (on a cluster:
a distributed file system; in tests: the session's checkpoint folder).
Tables are partitioned by ``ticker`` (and ``run_ts`` for registry runs)
with dynamic partition overwrite, so a re-run replaces only its own
partitions and a lost executor only re-does its own write tasks.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F, types as T


def run_stamp(now: _dt.datetime | None = None) -> str:
    """SRC-18: UTC ``yyyyMMddHHmmss`` run stamp (one literal per job)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y%m%d%H%M%S")


def write_partitioned(df: DataFrame, path: str, parts=("ticker",), fmt: str = "parquet") -> None:
    """SRC-07 / SRC-08 / SRC-13 / SRC-15: partitioned table, dynamic overwrite."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    df.write.mode("overwrite").partitionBy(*parts).format(fmt).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """SRC-12: CSV with header; values holding a comma, quote or newline are
    quoted, quotes doubled, NULL → empty field."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .option("nullValue", "").option("emptyValue", '""').option("quoteAll", False).csv(path))


def sanitize_non_finite(df: DataFrame) -> DataFrame:
    """REG-11: NaN / ±inf → NULL in double columns and double arrays
    (nested arrays included), before JSON output."""
    def fix(c, dt):
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None).cast(dt)).otherwise(c)
        if isinstance(dt, T.ArrayType):
            return F.transform(c, lambda x: fix(x, dt.elementType))
        if isinstance(dt, T.StructType):
            return F.struct(*[fix(c[f.name], f.dataType).alias(f.name) for f in dt.fields])
        return c
    return df.select(*[fix(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def to_json_rows(df: DataFrame, keep=("ticker",)) -> DataFrame:
    """SRC-14 sink form: one JSON document per row (non-finite → null)."""
    s = sanitize_non_finite(df)
    others = [c for c in s.columns if c not in keep]
    return s.select(*keep, F.to_json(F.struct(*others)).alias("payload"))


def read_json_docs(spark, path: str, schema=None) -> DataFrame:
    """SRC-14 source: multi-line JSON documents; a corrupt file becomes a row
    with NULL fields (PERMISSIVE) instead of failing the job."""
    r = spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def check_report(checks: DataFrame, part: str = "ticker", max_details: int = 800) -> DataFrame:
    """SRC-17: one JSON report and one Markdown text per ticker from long
    check rows (name, severity, value, details)."""
    rank = F.when(F.col("severity") == "severe", 2).when(F.col("severity") == "warning", 1).otherwise(0)
    bullet = F.concat(F.lit("- **"), F.col("name"), F.lit("**: "), F.col("severity"),
                      F.when(F.col("details").isNotNull(),
                             F.concat(F.lit(" — "), F.substring(F.col("details"), 1, max_details))).otherwise(F.lit("")))
    agg = checks.groupBy(part).agg(
        F.max(rank).alias("_r"),
        F.sort_array(F.collect_list(F.struct("name", "severity", "value", "details"))).alias("checks"),
        F.sort_array(F.collect_list(F.struct(F.col("name"), bullet.alias("b")))).alias("_b"))
    status = F.when(F.col("_r") == 2, "severe").when(F.col("_r") == 1, "warning").otherwise("ok")
    md = F.concat(F.lit("# Checks for "), F.col(part), F.lit("\n\nOverall: "), status, F.lit("\n\n"),
                  F.array_join(F.transform("_b", lambda x: x["b"]), "\n"))
    return agg.select(part, status.alias("overall_status"),
                      F.to_json(F.struct(F.col(part), status.alias("overall_status"), F.col("checks"))).alias("json"),
                      md.alias("markdown"))
