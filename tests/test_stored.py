"""Stored layouts: what they return, and what their plans leave unread (FLT-10, JOIN-1/4, FLT-9, DAT-1, JOIN-3)."""

import datetime as dt
import glob
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cinder import tables
from cinder.operators import stored
from conftest import rows
from test_weak_spots import _read_by


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def names(spark):
    made = [f"s_{uuid.uuid4().hex[:12]}" for _ in range(2)]
    yield made
    for t in [r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith(tuple(made))]:
        if spark.catalog.tableExists(t):
            tables.drop_table(spark, t)


def test_keyed_lookup_skips_row_groups(spark, tmp_dir):
    df = spark.range(0, 400_000, 2, 4).select((F.col("id") * 7919 % 400_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    stored.write_keyed(df, f"{tmp_dir}/t", "k", block_bytes=1 << 20)
    t = spark.read.parquet(f"{tmp_dir}/t")
    assert t.count() == 200_000
    one = df.where("k = 31676").first()
    got, read = _read_by(spark, "keyed", stored.lookup(t, "k", 31676).collect)
    assert [tuple(r) for r in got] == [tuple(one)] and 0 < sum(read) < 60_000
    got, read = _read_by(spark, "absent", stored.lookup(t, "k", 31677).collect)  # odd keys are not there, though within the bounds
    assert got == [] and sum(read) == 0, read
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,31676)]" in plan(stored.lookup(t, "k", 31676))


def test_keyed_lookup_of_other_types_and_hot_keys(spark, tmp_dir):
    df = spark.range(0, 60_000, 1, 6).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).cast("int").alias("k"), "id",
                                             F.create_map(F.lit("a"), "id").alias("m"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows would go to one file
    try:
        stored.write_keyed(df, f"{tmp_dir}/t", "k")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    t = spark.read.parquet(f"{tmp_dir}/t")
    assert stored.lookup(t, "k", 5).count() == df.where("k = 5").count() > 20_000
    hot = [f for f in glob.glob(f"{tmp_dir}/t/part-*") if stored.lookup(spark.read.parquet(f), "k", 5).count()]
    assert len(hot) >= 2  # a third of all rows: several files
    assert stored.lookup(t, "k", 1 << 40).count() == 0  # a value the column cannot hold
    assert stored.lookup(t, "k", None).count() == 0
    text = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    stored.write_keyed(text, f"{tmp_dir}/s", "k")
    assert [r.n for r in stored.lookup(spark.read.parquet(f"{tmp_dir}/s"), "k", "a").collect()] == [1]


@pytest.mark.parametrize("hot_rows", [1 << 20, 30])
def test_bucketed_join(spark, names, tmp_dir, hot_rows):
    left = spark.range(300).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 40)).alias("symbol"), F.col("id").alias("a"))
    left = left.unionByName(spark.createDataFrame([(None, 1)], "symbol string, a long"))
    right = spark.createDataFrame([("HOT", 1), ("HOT", 2), ("S1", 3), ("S1", 3), ("T", 4), (None, 5)], "symbol string, b long")
    stored.write_bucketed_pair(left, right, "symbol", *names, 4, tmp_dir, hot_rows)
    got = stored.join_bucketed(spark, *names, "symbol")
    assert rows(got) == rows(left.join(right, "symbol")) and got.where("symbol = 'HOT'").count() == 200
    assert len(glob.glob(f"{tmp_dir}/{names[0]}/part-*")) <= 4
    if hot_rows > 300:
        assert "Exchange" not in plan(got) and "SortMergeJoin" in plan(got) and not spark.catalog.tableExists(f"{names[0]}_hot")
    else:
        assert spark.table(f"{names[0]}_hot").count() == 100 and spark.table(f"{names[1]}_hot").count() == 2
    assert rows(stored.join_bucketed(spark, *names, "symbol", [], ["b"])) == rows(left.join(right, "symbol").select("symbol", "b"))


def orders(spark):
    at = lambda *a: dt.datetime(*a)
    return spark.createDataFrame([(1, "F", at(1997, 5, 1)), (2, "F", at(1997, 5, 31, 23, 59, 59)), (3, "O", at(1997, 5, 31)), (4, "F", at(1997, 6, 1)),
                                  (5, "F", at(1997, 5, 31)), (6, "F", None)], "o_orderkey long, o_orderstatus string, o_orderdate timestamp_ntz")


@pytest.mark.parametrize("unit", ["day", "month"])
def test_orders_by_time(spark, names, tmp_dir, unit):
    stored.store_by_time(orders(spark), names[0], "o_orderdate", "part", tmp_dir, unit, comment="by time")
    t = spark.table(names[0])
    assert t.count() == 6 and t.where("part IS NULL").count() == 1
    df = stored.orders_on_day(t, "F", dt.date(1997, 5, 31), "part", unit)
    (row,), read = _read_by(spark, f"by {unit}", df.collect)
    assert row.n_orders == 2 and sum(read) == {"day": 3, "month": 4}[unit]  # rows of the one partition
    assert "(part#" in plan(df).split("PartitionFilters: [")[1].split("]")[0]
    assert stored.orders_on_day(t, "F", dt.date(1980, 1, 1), "part", unit).first().n_orders == 0


def test_revenue_reads_the_months_asked_for(spark, names, tmp_dir):
    lines = spark.createDataFrame([(1, 10.10), (1, 0.05), (2, 1.0), (3, 100.0), (4, 1000.0), (5, 7.0), (6, 3.0), (99, 9.0)], "l_orderkey long, l_extendedprice double")
    stored.store_by_time(orders(spark), names[0], "o_orderdate", "order_month", tmp_dir, "month")
    stored.store_by_time(stored.lines_with_order_time(lines, orders(spark)), names[1], "o_orderdate", "order_month", tmp_dir, "month")
    df = stored.revenue_between(spark.table(names[1]), spark.table(names[0]), "F", dt.date(1997, 5, 1), dt.date(1997, 6, 1))
    (row,), read = _read_by(spark, "revenue", df.collect)
    assert row.total == Decimal("18.15") and sum(read) == 4 + 5, read
    assert plan(df).count("PartitionFilters: [isnotnull(order_month") + plan(df).count("PartitionFilters: [(order_month") >= 2
    part = stored.revenue_between(spark.table(names[1]), spark.table(names[0]), "F", dt.date(1997, 5, 31), dt.date(1997, 6, 2))
    assert part.first().total == Decimal("1008.00")
