"""Rules that hold at any size: no row limits, text stays text, repeated writes, status rows instead of silence."""
import itertools

import pytest
from pyspark.sql import functions as F

from tickwise.operators import checks as C
from tickwise.operators import cluster as CL
from tickwise.operators import joins as J
from tickwise.operators import metrics as M
from tickwise.operators import boosting as BO
from tickwise.operators import models as MD
from tickwise.operators import neighbors as NB
from tickwise.operators import projections as P
from tickwise.operators import rules as RU
from tickwise.sources import registry as REG


def _itemsets(baskets, support):
    out = {}
    for b in baskets:
        for n in range(1, len(b) + 1):
            for s in itertools.combinations(sorted(b), n):
                out[s] = out.get(s, 0) + 1
    return {s: c for s, c in out.items() if c / len(baskets) >= support}


def test_items_may_hold_commas(spark):
    baskets = [["a,b", "c"], ["a", "b"], ["a", "b", "c"], []]
    df = spark.createDataFrame([("t", b) for b in baskets], "ticker string, items array<string>")
    freq = RU.frequent_itemsets(df, 0.2)
    assert {tuple(r.itemset): r["count"] for r in freq.collect()} == _itemsets(baskets, 0.2)
    rules = [(tuple(r.antecedents), tuple(r.consequents), round(r.support, 6)) for r in RU.all_rules(freq, 0.1).collect()]
    assert len(rules) == len(set(r[:2] for r in rules)) and (("a,b",), ("c",), 0.25) in rules and (("a", "b"), ("c",), 0.25) in rules


def test_wide_baskets_cost_what_their_frequent_items_cost(spark):
    rows = [("t", [f"rare{i}_{k}" for k in range(40)] + ["x", "y"]) for i in range(20)]
    got = RU.frequent_itemsets(spark.createDataFrame(rows, "ticker string, items array<string>"), 0.5).collect()
    assert {tuple(r.itemset) for r in got} == {("x",), ("y",), ("x", "y")}


def test_registry_keeps_text_and_flat_runs(spark, tmp_path):
    meta = spark.createDataFrame([("007", 1), ("AB", 2)], "ticker string, v int")
    root = str(tmp_path)
    REG.write_artifact(meta, root, "pca", "")
    REG.write_artifact(meta.where("ticker = 'AB'"), root, "forecast", "20240101000000")
    REG.write_artifact(meta, root, "pca", "")  # written again: replaced, not doubled
    reg = REG.read_registry(spark, root)
    assert sorted((r.ticker, r.run_ts, r.kind) for r in reg.collect()) == [("007", "", "pca"), ("AB", "", "pca"), ("AB", "20240101000000", "forecast")]
    got = {r.ticker: r.run_ts for r in REG.newest_or_flat(reg, "pca").collect()}
    assert got == {"007": "", "AB": ""}
    assert {r.ticker: (r.run_ts, r.name) for r in REG.latest_with_kind(reg, "pca").collect()}["007"] == ("", "pca_007")


def test_a_run_that_broke_off_is_not_the_newest(spark, tmp_path):
    meta = spark.createDataFrame([("A", 1), ("B", 2)], "ticker string, v int")
    root = str(tmp_path)
    REG.open_run(spark, root)
    for kind in ("pca", "association"):
        REG.write_artifact(meta, root, kind, "20240101000000")
    assert REG.latest_run(REG.read_registry(spark, root)).collect() == []
    REG.publish_run(spark, root, "20240101000000", ["pca", "association"])
    REG.write_artifact(meta, root, "pca", "20240201000000")  # and here the job is lost
    reg = REG.read_registry(spark, root)
    assert {(r.ticker, r.run_ts) for r in REG.latest_run(reg).collect()} == {("A", "20240101000000"), ("B", "20240101000000")}
    assert reg.count() == 4 and REG.read_registry(spark, root, "20240201000000").count() == 6
    # a kind that the manifest doesn't name isn't part of its run
    REG.write_artifact(meta, root, "forecast", "20240101000000")
    assert REG.read_registry(spark, root).count() == 4
    with pytest.raises(ValueError):
        REG.publish_run(spark, root, "20240101000000", ["pca"])


@pytest.mark.parametrize("files", [(1, 1), (9, 4), (30, 2)])
def test_rows_meet_by_their_place_whatever_the_files(spark, tmp_path, files):
    left, right = str(tmp_path / "l"), str(tmp_path / "r")
    rows = spark.range(0, 1000).selectExpr("id", "id * 7 % 13 as x")
    rows.repartitionByRange(files[0], "id").sortWithinPartitions("id").write.parquet(left)
    rows.repartitionByRange(files[1], "id").sortWithinPartitions("id").selectExpr("id + 5 as y").write.parquet(right)
    got = J.join_by_position(spark.read.parquet(left), spark.read.parquet(right)).collect()
    assert sorted((r.position, r.id, r.y) for r in got) == [(i, i, i + 5) for i in range(1000)]


def test_infinities_count_as_missing(spark):
    df = spark.createDataFrame([("t", float("inf")), ("t", None), ("t", 1.0)], "ticker string, x double")
    assert M.missing_rate(df, ["x"]).first()["missing_rate"] == pytest.approx(2 / 3)


def test_fill_is_linear_and_right(spark):
    rows = [("t", i, v) for i, v in enumerate([None, 2.0, None, 4.0, None])] + [("u", 0, None)]
    df = spark.createDataFrame(rows, "ticker string, date int, x double")
    out = P.impute(df, ["x"])
    assert [r.x for r in out.orderBy("ticker", "date").collect()] == [2.0, 2.0, 2.0, 4.0, 4.0, 0.0]
    assert "unboundedfollowing" not in out._jdf.queryExecution().executedPlan().toString().lower()


def test_patience_waits_ten_rounds():
    falling = [1.0 - i / 100 for i in range(30)]
    assert BO.stopped_at(falling, 10) == (30, False)
    assert BO.stopped_at(falling[:5] + [2.0] * 9, 10) == (5, False)
    assert BO.stopped_at(falling[:5] + [2.0] * 10, 10) == (5, True)
    assert BO.stopped_at([], 10) == (0, False)


def test_expected_groups_have_a_row(spark):
    every = spark.createDataFrame([("a",), ("b",)], "ticker string")
    df = spark.createDataFrame([("a", 1.0)], "ticker string, x double")
    got = {(r.ticker, r.name): r.severity for r in C.integrity_checks(df, ["x"], date_col=None, expected=every).collect()}
    assert got["b", "file_non_empty"] == "severe" and got["a", "file_non_empty"] == "ok"
    scored = spark.createDataFrame([("a", i, 0.1, 0.1) for i in range(60)], "ticker string, date int, y double, p double")
    stored = spark.createDataFrame([("a", 0.2)], "ticker string, rmse double")
    gate = {(r.ticker, r.name): r.severity for r in C.regressor_gate(scored, "y", "p", stored, expected=every).collect()}
    assert gate == {("a", "regressor_performance"): "ok", ("b", "regressor_performance"): "warning", ("b", "regressor_artifacts"): "warning"}


def test_query_blocks_meet_every_row_once(spark):
    rows = spark.range(50).select(F.col("id").alias("r"))
    queries = spark.range(700).select(F.col("id").alias("q"))
    got = J.query_blocks(rows, queries, block=64).select("r", F.explode("queries").alias("x")).select("r", "x.q")
    assert got.count() == 50 * 700 == got.distinct().count()


def test_neighbours_without_groups_match_brute_force(spark):
    pts = [(i, [float(i * 7 % 13), float(i % 5)]) for i in range(40)]
    df = spark.createDataFrame(pts, "vec_id long, v array<double>")
    got = {}
    for r in NB.knn(df, df.where("vec_id < 3"), "v", 3, group=(), key="vec_id").collect():
        got.setdefault(r.target, []).append((r["rank"], r.vec_id))
    for t in range(3):
        want = sorted((((a - pts[t][1][0]) ** 2 + (b - pts[t][1][1]) ** 2) ** 0.5, i) for i, (a, b) in pts if i != t)[:3]
        assert [i for _, i in sorted(got[t])] == [i for _, i in want]


def test_kmeans_reports_every_group(spark):
    rows = [("a", i, float(i % 2) * 10 + i * 0.001) for i in range(20)] + [("b", 0, 1.0)]
    df = spark.createDataFrame(rows, "ticker string, date int, x double")
    labels, centers, summary = CL.kmeans(df, ["x"], k=2)
    got = {r.ticker: r for r in summary.collect()}
    assert got["a"].status == "ok" and got["a"].converged and sorted(got["a"].sizes) == [10, 10]
    assert got["b"].status == "skipped" and got["b"].n_rows == 1 and got["b"].inertia is None
    assert labels.count() == 20 and centers.count() == 1


def test_check_run_ends_with_a_status_and_an_exit_code(spark, tmp_path):
    def days(ticker, shift, rows=120):
        return [(ticker, i, float(i * 37 % 101) + shift, float(i)) for i in range(rows)]

    cols = "ticker string, day int, x double, y double"
    path = str(tmp_path / "baseline")
    first = spark.createDataFrame(days("007", 0) + days("B", 0), cols)
    base, fresh = REG.init_or_read_baseline(first, path)
    assert {r.ticker for r in fresh.collect()} == {"007", "B"}
    rows = C.check_run(first, ["x", "y"], base, fresh, expected=first)
    assert {r.overall_status for r in C.overall_status(rows).collect()} == {"ok"} and C.exit_code(C.overall_status(rows)) == 0
    # later: one ticker the same, one moved in every column, one without rows, one new
    later = spark.createDataFrame(days("007", 0) + [(t, d, x + 500, y + 500) for t, d, x, y in days("B", 0)] + days("N", 0), cols)
    every = later.select("ticker").unionByName(spark.createDataFrame([("gone",)], "ticker string"))
    base, fresh = REG.init_or_read_baseline(later, path)
    assert [r.ticker for r in fresh.collect()] == ["N"]
    rows = C.check_run(later, ["x", "y"], base, fresh, expected=every)
    got = {r.ticker: r.overall_status for r in C.overall_status(rows).collect()}
    assert got["007"] == "ok" and got["N"] == "ok" and got["B"] in ("severe", "warning") and got["gone"] == "severe"
    assert C.exit_code(C.overall_status(rows)) == 2 and C.exit_code(C.overall_status(rows), gate=False) == 0
