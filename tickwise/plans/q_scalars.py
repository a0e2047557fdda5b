"""Checked queries for scalar functions (SCL-*) and joins (JN-*)."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickwise.functions import scalars as S
from tickwise.functions.exprs import present
from tickwise.operators import joins as J
from tickwise.operators.timeseries import FEATURE_COLUMNS, feature_matrix
from tickwise.plans.catalog import register
from tickwise.plans.q_timeseries import features
from tickwise.plans.sqlparts import R, features_sql
from tickwise.sources.bars import bars_from_lineitem, bars_sql
from tickwise.session import scratch_path
from tickwise.sources.tables import read_table


#: Rows that a written file of the position join holds, about, once the table is large.
FILE_ROWS = 2_000_000

_FEATS = [c for c in FEATURE_COLUMNS if c != "date"]


@register("short_tokens", "SCL-02", r"""
    SELECT p_partkey, p_name, CASE WHEN len(parts) > 0
             THEN left(upper(array_to_string(list_transform(parts, lambda p: left(p, 1)), '')), 6)
             ELSE left(p_name, 6) END AS token
    FROM (SELECT p_partkey, p_name, list_filter(regexp_split_to_array(p_name, '[_\s\-]+'), lambda p: p <> '') AS parts
          FROM part)""")
def q_tokens(spark, sf):
    p = read_table(spark, sf, "part")
    return p.select("p_partkey", "p_name", S.short_token(F.col("p_name")).alias("token"))


@register("session_durations", "SCL-03", """
    SELECT user_id, concat_ws(' ', CASE WHEN s // 86400 > 0 THEN CAST(s // 86400 AS VARCHAR) || 'd' END,
                              CASE WHEN (s // 3600) % 24 > 0 THEN CAST((s // 3600) % 24 AS VARCHAR) || 'h' END,
                              CASE WHEN (s // 60) % 60 > 0 THEN CAST((s // 60) % 60 AS VARCHAR) || 'm' END,
                              CAST(s % 60 AS VARCHAR) || 's') AS duration
    FROM (SELECT user_id, CAST(trunc((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0) AS BIGINT) AS s
          FROM events GROUP BY user_id)""")
def q_durations(spark, sf):
    e = read_table(spark, sf, "events")
    us = F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))
    d = e.groupBy("user_id").agg((us / 1e6).alias("secs"))
    return d.select("user_id", S.humanize_seconds(F.col("secs")).alias("duration"))


def _size_sql(x: str) -> str:
    def r1(v):
        y = f"({v}) * 10.0"
        return (f"((floor({y}) + CASE WHEN {y} - floor({y}) > 0.5 OR ({y} - floor({y}) = 0.5 AND "
                f"floor({y}) % 2 = 1) THEN 1 ELSE 0 END) / 10.0)")
    parts = []
    for i, u in enumerate(S.SIZE_UNITS):
        sc = f"(CAST({x} AS DOUBLE) / {float(1024 ** i)!r})"
        parts.append(f"WHEN {sc} < 1024.0 THEN printf('%.1f', {r1(sc)}) || ' {u}'")
    pb = f"(CAST({x} AS DOUBLE) / {float(1024 ** 5)!r})"
    return f"CASE {' '.join(parts)} ELSE printf('%.1f', {r1(pb)}) || 'PB' END"


@register("human_sizes", "SCL-04", f"""
    SELECT doc_id, n_chars, {_size_sql('n_chars')} AS size_text,
           {_size_sql('n_chars * CAST(1099511627776 AS BIGINT)')} AS size_text_tb FROM documents""")
def q_sizes(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", "n_chars", S.human_size(F.col("n_chars")).alias("size_text"),
                    S.human_size(F.col("n_chars") * F.lit(1099511627776)).alias("size_text_tb"))


@register("safe_tickers", "SCL-05", """
    SELECT c_custkey, upper(coalesce(nullif(CASE WHEN c_acctbal < 0 THEN '' ELSE lower(c_mktsegment) END, ''), 'AAPL')) AS ticker
    FROM customer""")
def q_safe(spark, sf):
    c = read_table(spark, sf, "customer")
    # customers in debt have an empty symbol; the rest a lower-case one
    raw = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.lower(F.col("c_mktsegment")))
    return c.select("c_custkey", S.safe_ticker(raw).alias("ticker"))


@register("feature_windows", "SCL-06, AG-19", f"""
    SELECT ticker, CAST(max(w) AS BIGINT) AS max_history, CAST(count(*) AS BIGINT) AS n_features FROM (
      SELECT ticker, feature, coalesce(
        TRY_CAST(nullif(regexp_extract(feature, '^lag_close_(\\d+)$', 1), '') AS INTEGER),
        TRY_CAST(nullif(regexp_extract(feature, '^lag_return_(\\d+)$', 1), '') AS INTEGER),
        TRY_CAST(nullif(regexp_extract(feature, '^sma_(\\d+)$', 1), '') AS INTEGER),
        TRY_CAST(nullif(regexp_extract(feature, '^ema_(\\d+)$', 1), '') AS INTEGER), 1) AS w
      FROM (SELECT ticker, unnest(['{"', '".join(_FEATS)}']) AS feature
            FROM (SELECT DISTINCT ticker FROM ({bars_sql()}))))
    GROUP BY ticker""")
def q_windows(spark, sf):
    from tickwise.operators import metrics as M
    f = feature_matrix(bars_from_lineitem(spark, sf), drop_incomplete=False)
    prof = M.feature_profile(f, [c for c in f.columns if c not in ("ticker", "date")])
    return prof.groupBy("ticker").agg(F.max(S.feature_window(F.col("feature"))).cast("bigint").alias("max_history"),
                                      F.count(F.lit(1)).alias("n_features"))


@register("metric_text", "SCL-07", f"""
    SELECT ticker, {R('rmse', 'rmse_3', 3)}, printf('%.3f', {R('rmse', 'x', 3).replace(' AS x', '')}) AS rmse_text,
           {R('hit * 100.0', 'hit_pct', 1)}
    FROM (SELECT ticker, sqrt(avg("return" * "return")) AS rmse, avg(CASE WHEN "return" > 0 THEN 1.0 ELSE 0.0 END) AS hit
          FROM ({features_sql('l_suppkey')}) GROUP BY ticker)""")
def q_metric_text(spark, sf):
    f = features(spark, sf, "l_suppkey")
    a = f.groupBy("ticker").agg(F.sqrt(F.avg(F.col("return") * F.col("return"))).alias("rmse"),
                                F.avg((F.col("return") > 0).cast("double")).alias("hit"))
    from tickwise.functions.exprs import rounded
    return a.select("ticker", rounded(F.col("rmse"), 3).alias("rmse_3"), S.fixed(F.col("rmse"), 3).alias("rmse_text"),
                    S.percent(F.col("hit"), 1).alias("hit_pct"))


@register("json_key_fallback", "SCL-08", """
    SELECT event_id, coalesce(json_extract_string(props, '$.k_val'), json_extract_string(props, '$.k')) AS k
    FROM events""")
def q_json(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select("event_id", S.json_first(F.col("props"), "$.k_val", "$.k").alias("k"))


# ---- joins -------------------------------------------------------------------
@register("tail_alignment", "JN-03", f"""
    WITH a AS (SELECT ticker, date, Close, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS p FROM ({bars_sql()})),
    b AS (SELECT ticker, date, "return", row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS p FROM ({features_sql()}))
    SELECT a.ticker, a.p AS pos_from_end, a.date, {R('a.Close', 'Close')}, b.date AS r_date, {R('b."return"', 'r_return')}
    FROM a JOIN b ON a.ticker = b.ticker AND a.p = b.p""")
def q_tail(spark, sf):
    a = bars_from_lineitem(spark, sf).select("ticker", "date", "Close")
    b = features(spark, sf).select("ticker", "date", "return")
    t = J.tail_align(a, b)
    return present(t.select("ticker", F.col("_pos_from_end").cast("bigint").alias("pos_from_end"), "date", "Close",
                            "r_date", "r_return"))


@register("row_position_join", "JN-02, SRC-06", """
    SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment
    FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rid FROM orders) o
    JOIN (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rid FROM orders) k USING (rid)
    JOIN customer c ON c.c_custkey = o.o_custkey""")
def q_rowpos(spark, sf):
    # position = the row's index inside its own file, so the file is part of the key
    o = read_table(spark, sf, "orders").where(F.col("_metadata.file_size") > 0)
    left = o.select("o_orderkey", "o_custkey", F.col("_metadata.row_index").alias("row_id"), F.col("_metadata.file_path").alias("ticker"))
    right = read_table(spark, sf, "orders").select(F.col("_metadata.row_index").alias("row_id"),
                                                   F.col("_metadata.file_path").alias("ticker"))
    j = J.join_on_position(left, right)
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return j.join(c, "o_custkey").select("o_orderkey", "o_custkey", "c_mktsegment")


@register("global_position_join", "JN-02, SRC-06", """
    SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_quantity, l_shipdate) - 1 AS BIGINT) AS position, l_quantity, l_shipdate FROM lineitem""")
def q_global_position(spark, sf):
    """Two tables of the same order, written in 11 and 4 files (more of a table above 11 and 4 times ``FILE_ROWS``), joined by the place of a row."""
    rows = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    root, keys = scratch_path(spark, f"positions-{uuid.uuid4().hex}"), ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"]
    whole = -(-rows.count() // FILE_ROWS)
    for name, files, cols in (("left", max(11, whole), keys[:3]), ("right", max(4, whole), keys[3:])):
        rows.repartitionByRange(files, *keys).sortWithinPartitions(*keys).select(*cols).write.parquet(f"{root}/{name}")
    return J.join_by_position(spark.read.parquet(f"{root}/left"), spark.read.parquet(f"{root}/right"))


@register("tickers_without_baseline", "JN-07, SRC-16", f"""
    SELECT DISTINCT ticker FROM ({bars_sql('l_suppkey')}) b
    WHERE NOT EXISTS (SELECT 1 FROM ({bars_sql('l_suppkey')}) x WHERE x.ticker = b.ticker AND x.date < DATE '1995-01-20')""")
def q_no_baseline(spark, sf):
    bars = bars_from_lineitem(spark, sf, "l_suppkey")
    baseline = bars.where(F.col("date") < F.lit("1995-01-20").cast("date"))
    return J.groups_without(bars, baseline)
