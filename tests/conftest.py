import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("ledgerline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from ledgerline.session import scratch_path

    def make(name="t"):
        return scratch_path(spark, "tests", name)

    return make


def write_poll_files(log, directory, records_per_file, polls=None):
    """Small stream input: one file per poll of ``records_per_file`` offsets of every partition."""
    from pyspark.sql import functions as F

    if polls is None:
        polls = range(0, log.agg(F.max("offset")).first()[0] // records_per_file + 1)
    for i in polls:
        mine = log.where(F.floor(F.col("offset") / records_per_file) == i)
        mine.coalesce(1).write.parquet(f"{directory}/poll-{i:08d}")
