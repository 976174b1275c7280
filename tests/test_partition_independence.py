"""Same results whatever the shuffle partitioning (1 vs 13 partitions)."""

import pytest

import __spark_entry__ as E
from cinder.plans.catalog import REGISTRY
from conftest import SF_SMALL
from tools.check_oracle import digest

NAMES = sorted(REGISTRY)  # the training-data queries have tests of their own


@pytest.mark.parametrize("name", NAMES)
def test_query_partition_independent(spark, name):
    q = E.queries()[name]
    out = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = q(spark, SF_SMALL)
            out.append(digest(df.columns, [tuple(r) for r in df.collect()])[0])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1]


def test_number_rows_ties_and_nulls(spark):
    from cinder.operators.numbering import number_rows

    df = spark.createDataFrame([(k,) for k in ["b", "a", None, "b", "a", "a", None]], "k string")
    got = sorted((r.row_no, r.k) for r in number_rows(df.repartition(3), ["k"], num_partitions=4).collect())
    assert [g[0] for g in got] == list(range(1, 8))
    assert [g[1] for g in got] == [None, None, "a", "a", "a", "b", "b"]  # NULLs first, ascending
