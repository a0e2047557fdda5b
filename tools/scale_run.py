"""Many-ticker scale run: bars keyed by part (≈20 000 tickers at sf0.1)
through the grouped operators; prints one JSON line of wall seconds."""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window, functions as F  # noqa: E402

from tickwise.operators import checks as C  # noqa: E402
from tickwise.operators import cluster as CL  # noqa: E402
from tickwise.operators import forecast as FC  # noqa: E402
from tickwise.operators import metrics as M  # noqa: E402
from tickwise.operators import pca as PC  # noqa: E402
from tickwise.operators import rules as RU  # noqa: E402
from tickwise.operators.timeseries import FEATURE_COLUMNS, feature_matrix  # noqa: E402
from tickwise.session import configure, get_session  # noqa: E402
from tickwise.sources.bars import bars_from_lineitem  # noqa: E402


def run(name, df, out):
    t = time.time()
    df.write.format("noop").mode("overwrite").save()
    out[name] = round(time.time() - t, 2)


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = configure(get_session("local[8]", shuffle_partitions=16))
    out = {}
    bars = bars_from_lineitem(spark, sf, "l_partkey")
    out["n_tickers"] = bars.select("ticker").distinct().count()
    feats = feature_matrix(bars)
    run("feature_matrix", feats, out)
    w = Window.partitionBy("ticker").orderBy("date")
    scored = (feats.select("*", F.try_divide(F.lead("Close").over(w) - F.col("Close"), F.col("Close")).alias("nx"))
              .where(F.col("nx").isNotNull()).withColumn("y", (F.col("nx") > 0).cast("int"))
              .withColumn("p", F.col("rsi_14") / 100.0))
    run("roc_auc", M.roc_auc(scored, "y", "p"), out)
    n = F.count(F.lit(1)).over(Window.partitionBy("ticker"))
    h = feats.withColumn("_r", F.row_number().over(w)).withColumn("_n", n)
    base, cur = h.where("_r <= _n / 2").drop("_r", "_n"), h.where("_r > _n / 2").drop("_r", "_n")
    cols = [c for c in FEATURE_COLUMNS if c != "date"]
    run("ks_drift", C.drift_verdict(C.drift_columns(base, cur, cols)), out)
    run("association_rules", RU.mine_rules(feats, 0.05, 0.5, 200), out)
    meta, _ = PC.fit_pca(feats, cols, 5)
    run("pca", meta, out)
    run("correlation", M.correlation_long(feats, cols), out)
    t = time.time()
    fit = FC.fit_arima(bars)
    run("arima", fit, out)
    out["arima"] = round(time.time() - t, 2)  # with its eager steps
    z = PC.standardize_by_window(PC.pca_inputs(feats, cols, log_cols=()), cols).drop("mean", "scale", "const")
    t = time.time()
    _, _, summary = CL.kmeans(z, cols, k=5)
    run("kmeans", summary, out)
    out["kmeans"] = round(time.time() - t, 2)
    print(json.dumps({"metric": "many_ticker_scale_run", "sf": sf, "key": "l_partkey", "sec": out}))


if __name__ == "__main__":
    main()
