"""Run registry as tables (REG-01 … REG-12, SRC-16).

Layout under a shared root:  ``<root>/artifacts`` — one row per artifact
(ticker, run_ts, kind, name, payload JSON), partitioned by run_ts and kind and
read with a stated schema, so a ticker such as "007" stays text; matrix
artifacts (scores, labels) are their own partitioned tables.  Legacy flat
artifacts carry ``run_ts = ""`` (stored as ``flat``) and therefore sort before
every stamped run in string order.
"""
from __future__ import annotations

import json
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickwise.functions.scalars import human_size
from tickwise.session import materialize
from tickwise.sources.sinks import to_json_rows

ARTIFACTS = "ticker string, name string, payload string, run_ts string, kind string"
FLAT = "flat"
MANIFESTS = "manifests"
# The six model kinds a run can hold.
MODEL_KINDS = ["regressor", "classifier", "clusters", "pca", "forecast", "association"]


def _filesystem(spark: SparkSession, path: str):
    """Spark's own view of the folder, wherever it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def open_run(spark: SparkSession, root: str) -> None:
    """From now on ``root``'s readers go by manifests: a run is unseen until it is published."""
    fs, at = _filesystem(spark, os.path.join(root, MANIFESTS))
    fs.mkdirs(at)


def publish_run(spark: SparkSession, root: str, run_ts: str, kinds: list[str]) -> None:
    """Make a run visible with all its kinds at once: its manifest is written aside and renamed, which is one step.

    A run is published once; what it holds isn't written again.
    """
    fs, done = _filesystem(spark, os.path.join(root, MANIFESTS, f"{run_ts}.json"))
    if fs.exists(done):
        raise ValueError(f"run {run_ts} is published already")
    _, aside = _filesystem(spark, os.path.join(root, MANIFESTS, f"_{run_ts}.{uuid.uuid4().hex}"))  # readers skip names with an underscore
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps({"run_ts": run_ts, "kinds": sorted(kinds)}).encode()))
    out.close()
    if not fs.rename(aside, done):
        raise ValueError(f"run {run_ts} was published by another job")


def published(spark: SparkSession, root: str) -> DataFrame | None:
    """``(run_ts, kind)`` of the published runs; None for a root without manifests, where every run counts."""
    fs, at = _filesystem(spark, os.path.join(root, MANIFESTS))
    if not fs.exists(at):
        return None
    return spark.read.schema("run_ts string, kinds array<string>").json(os.path.join(root, MANIFESTS)).select("run_ts", F.explode("kinds").alias("kind"))


def write_artifact(meta: DataFrame, root: str, kind: str, run_ts: str, part: str = "ticker") -> None:
    """Store one metadata row per ticker as a JSON payload in a run."""
    rows = to_json_rows(meta, (part,)).select(part, F.lit(run_ts).alias("run_ts"), F.lit(kind).alias("kind"),
                                              F.concat(F.lit(kind + "_"), F.col(part)).alias("name"), "payload")
    stored = rows.withColumn("run_ts", F.when(F.col("run_ts") == "", FLAT).otherwise(F.col("run_ts")))
    # dynamic overwrite: writing a run's kind again replaces that kind of that run
    (stored.repartition("run_ts", "kind").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_ts", "kind").parquet(os.path.join(root, "artifacts")))


def read_registry(spark: SparkSession, root: str, own_run: str | None = None) -> DataFrame:
    """The artifacts of published runs, flat ones, and those that ``own_run``, a run still being written, has so far."""
    reg = spark.read.schema(ARTIFACTS).parquet(os.path.join(root, "artifacts"))
    reg = reg.withColumn("run_ts", F.when(F.col("run_ts") == FLAT, F.lit("")).otherwise(F.col("run_ts")))
    seen = published(spark, root)
    if seen is None:
        return reg
    always = F.col("run_ts").isin("", own_run or "")
    return reg.where(always).unionByName(reg.where(~always).join(seen, ["run_ts", "kind"], "left_semi").select(*reg.columns))


def latest_run(reg: DataFrame, part: str = "ticker") -> DataFrame:
    """REG-01: greatest stamped run per ticker (string order)."""
    return reg.where(F.col("run_ts") != "").groupBy(part).agg(F.max("run_ts").alias("run_ts"))


def latest_with_kind(reg: DataFrame, kind: str, part: str = "ticker") -> DataFrame:
    """REG-02: newest run that holds ``kind``; older runs next, flat last."""
    r = reg.where(F.col("kind") == kind)
    return (r.groupBy(part).agg(F.max_by(F.struct("run_ts", "name", "payload"), "run_ts").alias("a"))
            .select(part, "a.*"))


def newest_or_flat(reg: DataFrame, kind: str, part: str = "ticker") -> DataFrame:
    """REG-03: the artifact of the newest run only, else the flat one."""
    newest = latest_run(reg, part)
    art = reg.where(F.col("kind") == kind)
    hit = newest.join(art, [part, "run_ts"], "left").select(part, "run_ts", "name", "payload")
    flat = art.where(F.col("run_ts") == "").select(part, F.col("name").alias("f_name"),
                                                   F.col("payload").alias("f_payload"))
    allt = reg.select(part).distinct()
    j = allt.join(hit, part, "left").join(flat, part, "left")
    return j.select(part, F.when(F.col("payload").isNotNull(), F.col("run_ts")).otherwise(
                        F.when(F.col("f_payload").isNotNull(), F.lit(""))).alias("run_ts"),
                    F.coalesce("name", "f_name").alias("name"), F.coalesce("payload", "f_payload").alias("payload"))


def latest_prediction(preds: DataFrame, part: str = "ticker") -> DataFrame:
    """REG-04: the newest prediction row across runs."""
    others = [c for c in preds.columns if c != part]
    return preds.groupBy(part).agg(F.max_by(F.struct(*others), "run_ts").alias("p")).select(part, "p.*")


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """REG-05: every file under the registry: name, kind (extension), size,
    human size, modification time — the content column is pruned."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select("path", "length", "modificationTime"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select("path", name.alias("name"),
                        F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("kind"),
                        F.col("length").alias("size"), human_size(F.col("length")).alias("size_human"),
                        F.col("modificationTime").alias("mtime"))


def artifact_detail(reg: DataFrame) -> DataFrame:
    """REG-06: size of ``features`` / ``feature_order`` / ``centers`` when
    present, else the first 5 keys of the document."""
    keys = F.json_object_keys("payload")
    def n_of(k):
        return F.json_array_length(F.get_json_object("payload", f"$.{k}"))
    return reg.select("ticker", "run_ts", "kind", "name",
                      F.coalesce(n_of("features"), n_of("feature_order"), n_of("centers")).alias("n_items"),
                      F.get_json_object("payload", "$.generated_at").alias("generated_at"),
                      F.slice(keys, 1, 5).alias("first_keys"))


def array_summary(mat: DataFrame, col: str = "pc", group=("ticker",)) -> DataFrame:
    """REG-07: rows, width, element type, min and max of a matrix artifact —
    exact at any size (no first-100 sample)."""
    g = list(group)
    et = dict((f.name, f.dataType) for f in mat.schema.fields)[col].elementType.simpleString()
    return mat.groupBy(*g).agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.size(col)).alias("n_cols"),
                               F.lit(et).alias("dtype"), F.min(F.array_min(col)).alias("min"),
                               F.max(F.array_max(col)).alias("max"))


def run_summary(reg: DataFrame, part: str = "ticker") -> DataFrame:
    """REG-08: per (ticker, run) a present flag for each of the six kinds."""
    p = reg.where(F.col("run_ts") != "").groupBy(part, "run_ts").pivot("kind", MODEL_KINDS).agg(F.count(F.lit(1)))
    return p.select(part, "run_ts", *[(F.coalesce(F.col(k), F.lit(0)) > 0).alias(f"has_{k}") for k in MODEL_KINDS])


def model_lines(reg: DataFrame, part: str = "ticker") -> DataFrame:
    """REG-08: every stored model of a run with its one-line info: how many
    features, components or centres it has, else what it is."""
    def n_of(k):
        return F.json_array_length(F.get_json_object("payload", f"$.{k}"))
    counted = [(n_of(key) > 0, F.concat(F.lit(f"{word}="), n_of(key).cast("string")), kinds)
               for key, word, kinds in (("features", "features", ("regressor", "classifier")), ("components", "components", ("pca",)), ("centers", "centers", ("clusters",)))]
    info = F.when(F.col("kind") == "forecast", "forecast").when(F.col("kind") == "association", "rules")
    for has, text, kinds in counted:
        info = info.when(F.col("kind").isin(*kinds) & has, text)
    return reg.where(F.col("run_ts") != "").select(part, "run_ts", "kind", "name", info.otherwise("meta").alias("info"))  # a flat artifact is no run's


def overview(reg: DataFrame, part: str = "ticker") -> DataFrame:
    """REG-09: every ticker's runs in order, each with its artifacts and its models' lines (two-level sorted lists)."""
    runs = model_lines(reg, part).groupBy(part, "run_ts").agg(
        F.sort_array(F.collect_set("name")).alias("artifacts"), F.sort_array(F.collect_set(F.struct("kind", "info"))).alias("models"))
    return runs.groupBy(part).agg(F.sort_array(F.collect_list(F.struct("run_ts", "artifacts", "models"))).alias("runs"))


def expected_features(reg: DataFrame, kind: str = "regressor", part: str = "ticker") -> DataFrame:
    """REG-10: the feature list of the latest model of ``kind``."""
    m = latest_with_kind(reg, kind, part)
    arr = F.from_json(F.get_json_object("payload", "$.features"), "array<string>")
    return m.select(part, "run_ts", F.posexplode(arr).alias("pos", "feature"))


def read_back(reg: DataFrame, kind: str, part: str = "ticker", max_names: int = 50) -> DataFrame:
    """REG-12: latest stored result of a kind with provenance (run and its
    time, number of features and the first ``max_names`` names)."""
    m = latest_with_kind(reg, kind, part)
    names = F.from_json(F.coalesce(F.get_json_object("payload", "$.features"),
                                   F.get_json_object("payload", "$.feature_order")), "array<string>")
    return m.select(part, "run_ts", F.try_to_timestamp("run_ts", F.lit("yyyyMMddHHmmss")).alias("last_run"), "name", F.size(names).alias("n_features"),
                    F.slice(names, 1, max_names).alias("feature_names"), "payload")


def new_tickers(current: DataFrame, baseline: DataFrame, part: str = "ticker") -> DataFrame:
    """SRC-16 / JN-07: tickers of ``current`` with no stored baseline."""
    return current.select(part).distinct().join(baseline.select(part).distinct(), part, "left_anti")


def init_or_read_baseline(current: DataFrame, path: str, part: str = "ticker") -> tuple[DataFrame, DataFrame]:
    """SRC-16: append the rows of tickers without a baseline and report
    them (``baseline_initialized``); return (baseline, initialised tickers).

    The table is read with ``current``'s schema, so a ticker such as "007"
    stays text, and a repeated call finds its tickers stored and adds nothing.
    """
    spark = current.sparkSession
    reader = spark.read.schema(current.schema)
    try:
        base = reader.parquet(path)
    except AnalysisException:  # no baseline table yet
        base = None
    fresh = current.select(part).distinct() if base is None else new_tickers(current, base, part)
    fresh = materialize(fresh)
    current.join(fresh, part, "left_semi").select(*current.columns).repartition(part).write.mode("append").parquet(path)
    return reader.parquet(path), fresh
