"""Streaming bars equal batch bars; sinks round-trip; registry rules."""
import os

from pyspark.sql import functions as F

from tickwise.session import scratch_path
from tickwise.sources.bars import bars_from_lineitem
from tickwise.streaming.bars_stream import lineitem_bars_stream, start_bars_sink

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch_for_closed_days(spark):
    base = scratch_path(spark, "stream-test")
    ticks = os.path.join(base, "ticks")
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    # two arrivals: older half then newer half of the ship dates
    li.where(F.col("l_shipdate") < "1998-01-01").write.mode("overwrite").parquet(ticks + "/a")
    li.where(F.col("l_shipdate") >= "1998-01-01").write.mode("overwrite").parquet(ticks + "/b")
    flat = os.path.join(base, "ticks_flat")
    li.write.mode("overwrite").parquet(flat)
    q = start_bars_sink(lineitem_bars_stream(spark, flat), os.path.join(base, "bars"), os.path.join(base, "ck"))
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(base, "bars"))
    want = bars_from_lineitem(spark, SF)
    n = got.count()
    assert n > 0
    diff = got.select("ticker", "date", "Open", "Close", "Volume").exceptAll(
        want.select("ticker", "date", "Open", "Close", "Volume"))
    assert diff.count() == 0


def test_csv_and_json_sinks_round_trip(spark):
    from tickwise.sources.sinks import read_json_docs, sanitize_non_finite, write_csv
    base = scratch_path(spark, "sink-test")
    df = spark.createDataFrame([("a,b", 1.0, None), ('say "hi"', float("inf"), [1.0, float("nan")])],
                               "s string, x double, arr array<double>")
    write_csv(df.select("s", "x"), os.path.join(base, "csv"))
    back = spark.read.option("header", True).option("escape", '"').csv(os.path.join(base, "csv"))
    assert sorted(r["s"] for r in back.collect()) == ["a,b", 'say "hi"']
    clean = sanitize_non_finite(df).collect()
    assert clean[1]["x"] is None and clean[1]["arr"][1] is None
    sanitize_non_finite(df).coalesce(1).write.mode("overwrite").json(os.path.join(base, "json"))
    assert read_json_docs(spark, os.path.join(base, "json")).count() >= 1


def test_registry_resolution(spark):
    from tickwise.sources import registry as REG
    rows = [("A", "20240101000000", "pca", "p1", "{}"), ("A", "20240201000000", "forecast", "f2", "{}"),
            ("A", "", "pca", "flat", "{}"), ("B", "", "forecast", "flatB", "{}"),
            ("B", "20230101000000", "pca", "pB", "{}")]
    reg = spark.createDataFrame(rows, "ticker string, run_ts string, kind string, name string, payload string")
    assert {r["ticker"]: r["run_ts"] for r in REG.latest_run(reg).collect()} == {"A": "20240201000000",
                                                                                 "B": "20230101000000"}
    k = {r["ticker"]: r["name"] for r in REG.latest_with_kind(reg, "pca").collect()}
    assert k == {"A": "p1", "B": "pB"}                      # falls back to an older run
    f = {r["ticker"]: r["name"] for r in REG.newest_or_flat(reg, "pca").collect()}
    assert f == {"A": "flat", "B": "pB"}                     # newest run lacks pca → flat
    s = {(r["ticker"], r["run_ts"]): r["has_pca"] for r in REG.run_summary(reg).collect()}
    assert s[("A", "20240101000000")] and not s[("A", "20240201000000")]


def test_baseline_initialised_once_per_ticker(spark):
    from tickwise.sources.registry import init_or_read_baseline
    base = scratch_path(spark, "baseline-test")
    bars = bars_from_lineitem(spark, SF)
    first = bars.where(F.col("ticker").isin("A", "N"))
    _, fresh = init_or_read_baseline(first, base)
    assert sorted(r[0] for r in fresh.collect()) == ["A", "N"]
    stored, fresh2 = init_or_read_baseline(bars, base)
    assert [r[0] for r in fresh2.collect()] == ["R"]           # only the new ticker is added
    assert stored.count() == bars.count()


def test_ticker_files_loader(spark, tmp_path):
    from tickwise.sources.tables import load_ticker_files
    pdf = bars_from_lineitem(spark, SF).toPandas()
    d = tmp_path / "tickers"
    d.mkdir()
    for t, g in pdf.groupby("ticker"):
        g.drop(columns=["ticker"]).to_parquet(d / f"{t.lower()}.parquet")
    (d / "empty.parquet").write_bytes(b"")                      # zero-byte file is skipped
    got = load_ticker_files(spark, str(d)).groupBy("ticker").count().collect()
    want = pdf.groupby("ticker").size().to_dict()
    assert {r["ticker"]: r["count"] for r in got} == want


def test_check_report_json_and_markdown(spark):
    import json
    from tickwise.sources.sinks import check_report
    rows = [("A", "missingness", "ok", 0.01, None), ("A", "data_drift", "severe", 0.5, "x" * 2000),
            ("B", "duplicate_rows", "warning", 3.0, '{"duplicates":3}')]
    checks = spark.createDataFrame(rows, "ticker string, name string, severity string, value double, details string")
    rep = {r["ticker"]: r for r in check_report(checks).collect()}
    assert rep["A"]["overall_status"] == "severe" and rep["B"]["overall_status"] == "warning"
    doc = json.loads(rep["A"]["json"])
    assert doc["overall_status"] == "severe" and len(doc["checks"]) == 2
    md = rep["A"]["markdown"]
    assert md.startswith("# Checks for A") and "**data_drift**: severe" in md
    assert max(len(line) for line in md.splitlines()) < 900            # details cut at 800 characters
