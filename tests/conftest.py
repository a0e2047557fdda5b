import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from tickwise.session import SQL_CONF
    b = (SparkSession.builder.master("local[*]").appName("tickwise-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tw-test-ckpt-")))
    for k, v in SQL_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(s.conf.get("spark.checkpoint.dir"))
    yield s


@pytest.fixture(scope="session")
def bars_small(spark):
    from tickwise.sources.bars import bars_from_lineitem
    return bars_from_lineitem(spark, SF_SMALL).cache()
