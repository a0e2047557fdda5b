"""Shared pieces of the text operators: word patterns, table reading, shared-folder cuts, Arrow helpers."""
from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.session import checkpoint_dir

#: Fixed value: a word is a run of anything but space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"

#: Stands for a null id inside joins and minima: it sorts after every real id.
NULL_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text, in order; empty for an empty text."""
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table in the shared checkpoint folder, which survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle(df: DataFrame, rows: int, per_task: int = 100_000) -> DataFrame:
    """Partitions by the number of narrow rows, and a task per core at least: a small table isn't dealt over thousands."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task)))


def hold(df: DataFrame) -> DataFrame:
    """The same rows, passed through a generator: a filter above stays above.

    Pushed below, a filter on a computed array would compute it again, and
    once for each use inside a lambda.
    """
    return df.select(F.explode_outer(F.array(F.struct("*"))).alias("__row")).select("__row.*")


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python, whatever folder they start in; once per context."""
    sc = spark.sparkContext
    if any(f.endswith("/tickwise.zip") for f in sc.listFiles):
        return
    root = Path(__file__).resolve().parents[1]
    own = tempfile.mkdtemp(prefix="tickwise-")  # the driver serves the file from here as long as it lives
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    with zipfile.ZipFile(f"{own}/tickwise.zip", "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(f"{own}/tickwise.zip")


def map_rows(df: DataFrame, schema: str, fn: Callable[[list[list]], list[list]]) -> DataFrame:
    """``fn`` gets the columns of an Arrow batch as Python lists and returns the columns of ``schema``.

    Batches stream through the worker, so memory follows the batch, not the partition.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship(df.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # long texts: few of them as Python objects at a time
                part = batch.slice(at, 512)
                got = fn([part.column(i).to_pylist() for i in range(part.num_columns)])
                yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(got, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)
