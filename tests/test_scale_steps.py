"""Steps that keep a task's share of a growing table bounded, and tables that are built once."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickwise.operators import projections as P
from tickwise.operators import quantiles as Q
from tickwise.operators.ema import powers
from tickwise.plans import pipeline, q_checks, q_models, q_scalars
from tickwise.sources import bars as B

TICKS = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, l_shipdate timestamp, l_returnflag string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows = [(i, 1, i, i % 40, 100.0 + (i * 7919 % 31), 1.0 + i % 5, dt.datetime(2020, 1, 1) + dt.timedelta(days=i // 40), "AB"[i % 2]) for i in range(2400)]
    sf = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, TICKS).repartition(3).write.parquet(f"{sf}/lineitem.parquet")
    return sf


def test_bars_of_many_tickers_are_dealt_by_their_ticks(spark, tables):
    ticks = spark.read.parquet(f"{tables}/lineitem.parquet")
    made = B.bars_from_lineitem(spark, tables, "l_suppkey")
    dealt = B.dealt(made, ticks, "l_suppkey", part_ticks=80)
    assert dealt.rdd.getNumPartitions() == 30
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, made.collect()))
    assert dealt.select("ticker", F.spark_partition_id().alias("p")).distinct().count() == 40
    # what the cores hold anyway, and fewer tickers than parts, stay
    assert B.dealt(made, ticks, "l_suppkey", part_ticks=2400) is made
    assert B.dealt(made, ticks, "l_returnflag", part_ticks=80) is made


def test_feature_rows_of_the_models_are_built_once(spark, tables, monkeypatch):
    built = []
    whole = q_models.features
    monkeypatch.setattr(q_models, "features", lambda *a: built.append(a) or whole(*a))
    one, two = q_models._feats(spark, tables), q_models._feats(spark, tables)
    assert len(built) == 1 and one.inputFiles() == two.inputFiles() == []  # the ticks are not read again
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, whole(spark, tables).collect()))


def test_a_run_builds_the_bars_once(spark, tables, tmp_path, monkeypatch):
    read = []
    whole = pipeline.bars_from_lineitem

    def counted(*a):
        out = whole(*a)
        read.append(out)
        return out
    monkeypatch.setattr(pipeline, "bars_from_lineitem", counted)
    used = []
    deal = pipeline.feature_matrix
    monkeypatch.setattr(pipeline, "feature_matrix", lambda b: used.append(b) or deal(b))
    pipeline.run_pipeline(spark, tables, str(tmp_path / "r"), steps=["association"], run_ts="20240101000000")
    assert len(read) == 1 and all("/bars/" in f for f in used[0].inputFiles())


def test_constant_columns_do_not_multiply_rows(spark):
    df = spark.createDataFrame([("a", 1.0, None, 2), ("a", 1.0, None, 3), ("b", None, 5.0, 4), ("b", 1.0, 5.0, 4), (None, 7.0, 7.0, 7), ("n", float("nan"), 1.0, 1), ("n", float("nan"), 2.0, 1)],
                               "ticker string, x double, y double, z int")
    out = P.constant_columns(df, ["x", "y", "z"])
    got = {(r.ticker, r.feature): r.is_constant for r in out.collect()}
    want = {("a", "x"): True, ("a", "y"): True, ("a", "z"): False, ("b", "x"): False, ("b", "y"): True, ("b", "z"): True,
            (None, "x"): True, (None, "y"): True, (None, "z"): True, ("n", "x"): True, ("n", "y"): False, ("n", "z"): True}
    assert got == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # unpivoted above the aggregate


def test_gates_store_only_what_they_read(spark, tables, monkeypatch):
    import tickwise.session as S
    kept = []
    whole = S.materialize
    monkeypatch.setattr(S, "materialize", lambda df: kept.append(df.columns) or whole(df))
    q_checks._gates(spark, tables)
    assert kept == [["ticker", "date", "return", "target_return", "y", "p"]]


def test_position_files_grow_with_the_table(spark, tables, monkeypatch):
    monkeypatch.setattr(q_scalars, "FILE_ROWS", 100)
    files = []
    whole = q_scalars.J.join_by_position
    monkeypatch.setattr(q_scalars.J, "join_by_position", lambda a, b: files.append((len(a.inputFiles()), len(b.inputFiles()))) or whole(a, b))
    out = q_scalars.q_global_position(spark, tables).orderBy("position").collect()
    assert min(files[0]) > 15
    assert [r.position for r in out] == list(range(2400)) and [r.l_orderkey for r in out] == list(range(2400))


def test_a_small_groups_quantile_takes_no_json_key(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(10)] + [(None, 4.0), (None, None), ("e", None)], "g string, v double")
    out = Q.exact_quantile(df, "v", 0.8, ["g"], "t")
    assert {r.g: r.t for r in out.collect()} == {"a": pytest.approx(7.2), None: 4.0, "e": None}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "json" not in plan
    assert Q.exact_quantile(df.where("false"), "v", 0.8, [], "t").collect() == []


def test_powers_are_sparks_own(spark):
    k = spark.range(128).select(F.col("id").cast("int").alias("k"))
    for q, shift, sign in ((1 / 3, 0, -1), (0.9, 129, 1)):
        same = k.select((powers(spark, q, F.col("k"), 128, shift, sign) == F.pow(F.lit(q), sign * F.col("k") + F.lit(shift))).alias("s"))
        assert same.where("s").count() == 128
