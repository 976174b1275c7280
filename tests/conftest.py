import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cinder.session import RECOMMENDED_CONF

    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.log.structuredLogging.enabled", "false").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cinder-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="cinder-test-")


def lines_df(spark, lines, partitions=None):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return df.repartition(partitions) if partitions else df


def rows(df):
    return sorted(tuple(r) for r in df.collect())
