"""Folders of per-ticker files in one or both formats, label fallbacks, and the gates on stored models."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tickwise.operators import models as MD
from tickwise.plans import pipeline as PL
from tickwise.sources import registry as REG
from tickwise.sources.tables import load_frame, load_ticker_files


def bars(n, close):
    import pandas as pd

    return pd.DataFrame({"date": [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(n)], "Close": [close + i for i in range(n)]})


def test_folders_of_ticker_files(spark, tmp_path):
    both, csv, none = (tmp_path / n for n in ("both", "csv", "none"))
    for d in (both, csv, none):
        d.mkdir()
    bars(3, 1.0).to_parquet(both / "aapl.parquet")
    bars(2, 5.0).to_csv(both / "msft.csv", index=False)
    (both / "empty.csv").write_bytes(b"")
    bars(4, 7.0).to_csv(csv / "ibm.csv", index=False)
    (none / "notes.txt").write_text("nothing")
    count = lambda d: {r.ticker: r["count"] for r in load_ticker_files(spark, str(d)).groupBy("ticker").count().collect()}
    assert count(both) == {"AAPL": 3, "MSFT": 2}
    assert count(csv) == {"IBM": 4}
    with pytest.raises(FileNotFoundError):
        load_ticker_files(spark, str(none))
    got = load_frame(spark, str(csv / "ibm.csv"))
    assert (got.count(), dict(got.dtypes)["Close"]) == (4, "double")


def test_label_fallbacks(spark):
    rows = [("A", dt.date(2024, 1, 1 + i), c, r, t) for i, (c, r, t) in enumerate([(1.0, 0.1, -1.0), (2.0, -0.2, 2.0), (1.5, 0.3, None), (1.5, -0.4, 0.0)])]
    f = spark.createDataFrame(rows, "ticker string, date date, Close double, log_return double, mine double")

    def labels(df, **kw):
        return [r.label for r in MD.label_direction(df, **kw)[0].orderBy("date").collect()]

    assert labels(f) == [1, 0, 0]
    assert labels(f.drop("Close")) == [0, 1, 0]
    assert labels(f, target_col="mine") == [0, 1, 0]
    assert labels(f, target_col="unknown") == [1, 0, 0]
    assert "log_return" not in MD.label_direction(f)[1]
    with pytest.raises(ValueError):
        MD.label_direction(f.drop("Close", "log_return"))


def test_a_whole_run_gates_its_stored_models(spark, tmp_path):
    root = str(tmp_path / "run")
    run = PL.run_pipeline(spark, "/root/testdata/sf0.001", root, steps=["regressor", "classifier", "next_day", "checks"],
                          reg_params=dict(maxIter=2, maxDepth=2, seed=1), cls_params=dict(rounds=2, depth=2))
    checks = spark.read.json(os.path.join(root, "reports", run)).select(F.explode(F.from_json(
        F.get_json_object("json", "$.checks"), "array<struct<name:string,severity:string,value:double>>")).alias("c")).select("c.*")
    names = {r.name for r in checks.collect()}
    assert {"regressor_performance", "classifier_performance", "feature_count", "baseline_initialized"} <= names
    assert {r.severity for r in checks.where("name = 'feature_count'").collect()} == {"ok"}
    reg = REG.read_registry(spark, root)
    lines = {(r.kind, r.info) for r in REG.model_lines(reg).collect()}
    assert lines == {("regressor", "features=26"), ("classifier", "features=25")}
    back = REG.read_back(reg, "classifier").first()
    assert back.run_ts == run and back.last_run is not None and back.n_features == 25
    # a ticker without stored models is a warning of each kind
    feats = spark.read.parquet(os.path.join(root, "features"))
    every = feats.select("ticker").distinct().unionByName(spark.createDataFrame([("new",)], "ticker string"))
    lost = [r.name for g in PL.stored_gates(spark, feats, root, every) for r in g.where("ticker = 'new'").collect()]
    assert sorted(lost) == ["classifier_artifacts", "regressor_artifacts"]
