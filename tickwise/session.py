"""Session construction and cluster-safe scratch locations."""
from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings a job of this package expects.  Everything here is a SQL conf that
# can also be set on an existing session (see ``configure``).
SQL_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Feature plans are wide (27+ columns, NULL filters on all of them, the
    # same lineage joined with its own aggregates).  Constraint propagation
    # enumerates alias/constraint combinations on such plans and can stall
    # the optimizer for minutes; the filters it would infer are not needed.
    "spark.sql.constraintPropagation.enabled": "false",
}


# Settings for a large cluster (≈100 TB input, ~1000 executors).  Scans are
# split into 512 MB input partitions; shuffles start wide and AQE coalesces
# them towards 256 MB and splits skewed partitions (a hot ticker or day).
# Per-ticker tables after the bar builder are small, so the broadcast
# threshold stays moderate and the library adds its own row-count checks.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def configure_for_cluster(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Apply ``SQL_CONF`` plus the cluster sizing above (SQL confs only)."""
    configure(spark)
    for k, v in CLUSTER_CONF.items():
        spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, app: str = "tickwise",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.  ``master`` is only for local runs; on a
    cluster the launcher decides it."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.driver.memory", os.environ.get("TICKWISE_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SQL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is.  Only when it is unset on a local master — tests — a
    private folder under the system temp dir is created and registered; other
    machines could not read such a folder, so elsewhere this is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="tickwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python, whatever folder they start in; once per context."""
    sc = spark.sparkContext
    if any(f.endswith("/tickwise.zip") for f in sc.listFiles):
        return
    root = Path(__file__).resolve().parent
    own = tempfile.mkdtemp(prefix="tickwise-")  # the driver serves the file from here as long as it lives
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    with zipfile.ZipFile(f"{own}/tickwise.zip", "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(f"{own}/tickwise.zip")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark).rstrip("/"), name)


def materialize(df):
    """Write an intermediate that several branches of a plan consume once
    to the shared checkpoint folder (lineage cut; re-read, not recomputed,
    also after an executor loss).  Never ``localCheckpoint``."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
