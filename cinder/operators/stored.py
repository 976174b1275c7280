"""Stored layouts that spare a query work: tables in key order with Bloom filters (FLT-10), lists
bucketed by their join key (JOIN-1, JOIN-4, MEM-1), rows partitioned by day (FLT-9, DAT-1, JOIN-3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinder import versioned
from cinder.functions.numbers import MONEY
from cinder.operators.retail import TOTAL, day_range
from cinder.operators.staging import release, stage
from cinder.sources.external import overwrite_load

#: Rows of one key from which its rows are stored apart from the buckets.
HOT_ROWS = 1 << 20


# ---------------------------------------------------------------- by key

def write_keyed(df: DataFrame, path: str, key: str, block_bytes: int = 128 << 20) -> None:
    """Parquet files in key order, so that row groups span narrow key ranges, with a Bloom filter of the key in each.

    Ranges are balanced by key and row, so a key on very many rows takes several files.
    """
    rest = F.xxhash64(*[F.col(c) for c, t in df.dtypes if c != key and not t.startswith("map")] or [F.lit(0)])
    (df.withColumn("_tie", rest).repartitionByRange(key, "_tie").sortWithinPartitions(key).drop("_tie").write
     .option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
     .option("parquet.block.size", str(block_bytes)).parquet(path))


def lookup(keyed: DataFrame, key: str, value) -> DataFrame:
    """Rows of one key. The value takes the stored column's type, so the comparison reaches the scan, which skips
    row groups by their bounds and Bloom filters; a value that type cannot hold finds nothing."""
    return keyed.where(F.col(key) == F.lit(value).try_cast(keyed.schema[key].dataType))


# ---------------------------------------------------------------- by join key

def write_bucketed_pair(left: DataFrame, right: DataFrame, key: str, left_table: str, right_table: str, buckets: int,
                        location: str, hot_rows: int = HOT_ROWS) -> None:
    """Both lists as tables bucketed and sorted by ``key``, each bucket one file. Rows without a key, which join nothing, are left out.

    A bucket is joined by one task. Keys with over ``hot_rows`` rows on a side therefore stand apart, for both
    sides, in plain tables ``<table>_hot``, whose join Spark can split; without such keys there are none.
    """
    sides = [(stage(df.where(F.col(key).isNotNull()), "list"), table) for df, table in ((left, left_table), (right, right_table))]
    often = [df.groupBy(key).count().where(F.col("count") > hot_rows).select(key) for df, _ in sides]
    hot = stage(often[0].unionByName(often[1]).distinct(), "hot")
    none = hot.isEmpty()
    for df, table in sides:
        rest = df if none else df.join(hot, key, "left_anti")
        rest.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", f"{location}/{table}").saveAsTable(table)
        if not none:
            df.join(hot, key, "left_semi").write.option("path", f"{location}/{table}_hot").saveAsTable(f"{table}_hot")
    release(hot, *[df for df, _ in sides])


def join_bucketed(spark: SparkSession, left_table: str, right_table: str, key: str, left_columns: list | None = None,
                  right_columns: list | None = None) -> DataFrame:
    """Inner join of two lists of :func:`write_bucketed_pair`, bucket by bucket and without a shuffle; duplicate keys multiply."""
    def sides(suffix=""):
        for table, columns in ((left_table, left_columns), (right_table, right_columns)):
            df = spark.table(table + suffix)
            yield df.select(key, *columns) if columns is not None else df
    left, right = sides()
    out = left.hint("merge").join(right, key)
    if spark.catalog.tableExists(f"{left_table}_hot"):
        left, right = sides("_hot")
        out = out.unionByName(left.join(right, key))
    return out


# ---------------------------------------------------------------- by day

def first_day(column: Column, unit: str) -> Column:
    """The day a timestamp lies on, or the first day of its month, as a DATE."""
    return column.cast("date") if unit == "day" else F.trunc(column.cast("date"), "month")


def store_by_time(df: DataFrame, name: str, when: str, column: str, location: str, unit: str = "day", comment: str | None = None) -> None:
    """A versioned table partitioned by ``column``, the day or month of ``when``. Large partitions are written as several files."""
    dated = df.withColumn(column, first_day(F.col(when), unit))
    versioned.create_versioned(df.sparkSession, name, dated.schema, partitioned_by=(column,), comment=comment, location=location)
    overwrite_load(dated.hint("rebalance", column), name)


def orders_on_day(stored: DataFrame, status: str, day: dt.date, column: str = "order_month", unit: str = "month") -> DataFrame:
    """Orders of a status on a day, from the one partition that holds it."""
    part = F.col(column) == F.lit(day if unit == "day" else day.replace(day=1))
    return stored.where(part & day_range("o_orderdate", day) & (F.col("o_orderstatus") == status)).agg(F.count("o_orderkey").alias("n_orders"))


def lines_with_order_time(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with the date of their order, to be stored by it. Lines without an order have none."""
    when = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return lineitem.join(when, "l_orderkey", "left")


def revenue_between(lines: DataFrame, orders: DataFrame, status: str, start: dt.date, end: dt.date, column: str = "order_month") -> DataFrame:
    """Sum of the lines of orders with a status in [start, end), both stored by month: a semi-join on month and order.

    Only the months asked for are read on either side; the lines' months follow from the join.
    """
    months = (F.col(column) >= F.lit(start.replace(day=1))) & (F.col(column) < F.lit(end))
    keys = (orders.where(months & (F.col("o_orderstatus") == status) & day_range("o_orderdate", start, end))
            .select(F.col("o_orderkey").alias("l_orderkey"), column))
    picked = lines.join(keys, [column, "l_orderkey"], "left_semi")
    return picked.agg(F.sum(F.col("l_extendedprice").cast(MONEY)).cast(TOTAL).alias("total"))
