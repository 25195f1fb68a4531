import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[*]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(
            spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="lakecube-test-ckpt-"))
    yield spark


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"


def small_grid(spark, rows):
    """Hand-written grid rows: (time 'YYYY-MM-DD', lat_idx, lon_idx, sst)."""
    data = [(dt.date.fromisoformat(t), i, j, 40.0 + i, -90.0 + j, v) for t, i, j, v in rows]
    return spark.createDataFrame(
        data, "time date, lat_idx bigint, lon_idx bigint, lat double, lon double, sst double")
