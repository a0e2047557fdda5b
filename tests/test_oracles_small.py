"""A sample of Spark queries against their DuckDB oracles at sf0.001."""
import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SAMPLE = ["bars_daily", "feature_matrix", "roc_auc", "ks_drift_columns", "association_rules",
          "arima_fit", "calibration_report", "embedding_knn", "human_sizes", "stratified_split"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "hour") and hasattr(v, "date"):
        return v.date()
    if isinstance(v, float):
        return round(v, 9)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    q, o = E.queries(), E.oracle_sql()
    a = q[name](spark, "/root/testdata/sf0.001").toPandas()
    b = con.execute(o[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    ra = sorted(tuple(str(_norm(r[c])) for c in cols) for r in a.to_dict("records"))
    rb = sorted(tuple(str(_norm(r[c])) for c in cols) for r in b.to_dict("records"))
    assert ra == rb
