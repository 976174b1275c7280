"""The retail worksheet (FLT-7..10, JOIN-2/3, AGG-5..10, SRT-3, TOP-3/4, LIM-1,
DST-1, FMT-1, DAT-1), each as a DataFrame function with its parameters.

Tables are passed in, so the same functions run on any customer / product /
order tables with the right columns. ``SQL`` holds the same queries as Spark SQL
text over temp views (the second route used by the tests).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinder.functions.formatting import dollars_plain
from cinder.functions.numbers import MONEY

TOTAL = "decimal(38,2)"


def _ntz(d: dt.date) -> F.Column:
    # string -> TIMESTAMP_NTZ does not depend on the session time zone
    return F.lit(d.isoformat()).cast("timestamp_ntz")


def day_range(col: str, start: dt.date, end: dt.date | None = None) -> F.Column:
    """Half-open [start, end) on a timestamp column; end defaults to the next day.

    Written as a range (not year()/month()/day()) so the scan can push it down.
    """
    end = end or (start + dt.timedelta(days=1))
    return (F.col(col) >= _ntz(start)) & (F.col(col) < _ntz(end))


def filter_like_prefix(customer: DataFrame, segment: str, name_prefix: str) -> DataFrame:
    """``WHERE seg = ... AND name LIKE 'prefix%'`` (case-sensitive); both reach the scan."""
    return customer.where(
        (F.col("c_mktsegment") == segment) & F.col("c_name").startswith(name_prefix)
    ).select("c_custkey", "c_name", "c_mktsegment")


def lowest_price(part: DataFrame, k: int = 10) -> DataFrame:
    """Rows at the minimum price, ordered by price then key, first ``k``."""
    lo = part.agg(F.min("p_retailprice").alias("_lo"))  # exactly one row: safe to broadcast
    return (
        part.select("p_partkey", "p_name", "p_retailprice")
        .join(F.broadcast(lo), F.col("p_retailprice") == F.col("_lo"), "left_semi")
        .orderBy("p_retailprice", "p_partkey")
        .limit(k)
    )


def _address(customer: DataFrame) -> F.Column:
    # NULL if any part is NULL, no separator between the parts (as the worksheet did)
    return F.concat(F.col("c_mktsegment"), F.col("c_nationkey").cast("string"))


def count_distinct_concat(customer: DataFrame) -> DataFrame:
    return customer.agg(F.count_distinct(_address(customer)).alias("n_distinct"))


def distinct_addresses(customer: DataFrame, k: int = 10) -> DataFrame:
    return customer.select(_address(customer).alias("address")).distinct().orderBy("address").limit(k)


def customers_per_group(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customers per nation name, most first. Counted per key before the join, so
    the join sees one row per nation key instead of one per customer."""
    per_key = customer.groupBy("c_nationkey").agg(F.count("c_custkey").alias("_n"))
    return (
        per_key.join(nation, per_key.c_nationkey == nation.n_nationkey)
        .groupBy("n_name")
        .agg(F.sum("_n").cast("bigint").alias("customer_count"))
        .orderBy(F.desc("customer_count"), "n_name")
    )


def top_products(lineitem: DataFrame, part: DataFrame, k: int = 3) -> DataFrame:
    """Top ``k`` products by total quantity. Quantities are summed per part key
    first (partial + final aggregate), then joined to the part names."""
    qty = lineitem.groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast(MONEY)).cast(MONEY).alias("total_qty")
    )
    return (
        qty.join(part, qty.l_partkey == part.p_partkey)
        .groupBy(F.col("l_partkey").alias("product_id"), F.col("p_name"))
        .agg(F.sum("total_qty").cast(MONEY).alias("total_qty"))
        .orderBy(F.desc("total_qty"), "product_id")
        .limit(k)
    )


def orders_on_day(orders: DataFrame, status: str, day: dt.date) -> DataFrame:
    return orders.where((F.col("o_orderstatus") == status) & day_range("o_orderdate", day)).agg(
        F.count("o_orderkey").alias("n_orders")
    )


def _orders_in(orders: DataFrame, status: str, start: dt.date, end: dt.date | None) -> DataFrame:
    return orders.where((F.col("o_orderstatus") == status) & day_range("o_orderdate", start, end)).select(
        "o_orderkey"
    )


def revenue_on_day(lineitem: DataFrame, orders: DataFrame, status: str, start: dt.date,
                   end: dt.date | None = None) -> DataFrame:
    """Sum of line prices of the orders with ``status`` in [start, end): a semi-join
    (``IN (subquery)``), summed as DECIMAL so the total does not depend on order.

    One plan at every size: the filters on orders reach its scan, AQE picks the
    join from the real size of the keys, and Spark prunes lineitem with a Bloom
    filter of the keys where the join shuffles.
    """
    keys = _orders_in(orders, status, start, end)
    picked = lineitem.join(keys, lineitem.l_orderkey == keys.o_orderkey, "left_semi")
    return picked.agg(F.sum(F.col("l_extendedprice").cast(MONEY)).cast(TOTAL).alias("total"))


def revenue_formatted(lineitem: DataFrame, orders: DataFrame, status: str, start: dt.date,
                      end: dt.date | None = None) -> DataFrame:
    return revenue_on_day(lineitem, orders, status, start, end).select(dollars_plain(F.col("total")).alias("total"))


def orders_by_calendar_day(orders: DataFrame) -> DataFrame:
    """Orders per calendar day, by ``year()``, ``month()`` and ``day()`` of the timestamp (DAT-1)."""
    when = F.col("o_orderdate")
    return orders.groupBy(F.year(when).alias("order_year"), F.month(when).alias("order_month"), F.day(when).alias("order_day")).agg(
        F.count("o_orderkey").alias("n_orders"))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


# The same queries as SQL text over temp views (customer, nation, part,
# lineitem, orders), for ``spark.sql(text, args={...})`` with named parameters.
SQL = {
    "filter_like_prefix": """
        SELECT c_custkey, c_name, c_mktsegment FROM customer
        WHERE c_mktsegment = :segment AND c_name LIKE concat(:prefix, '%')""",
    "lowest_price": """
        SELECT p_partkey, p_name, p_retailprice FROM part
        WHERE p_retailprice = (SELECT min(p_retailprice) FROM part)
        ORDER BY p_retailprice, p_partkey LIMIT :k""",
    "count_distinct_concat": """
        SELECT count(DISTINCT concat(c_mktsegment, CAST(c_nationkey AS STRING))) AS n_distinct FROM customer""",
    "distinct_addresses": """
        SELECT DISTINCT concat(c_mktsegment, CAST(c_nationkey AS STRING)) AS address FROM customer
        ORDER BY address LIMIT :k""",
    "customers_per_group": """
        SELECT n_name, count(c_custkey) AS customer_count
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_name ORDER BY customer_count DESC, n_name""",
    "top_products": """
        SELECT p_partkey AS product_id, p_name, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_qty
        FROM part JOIN lineitem ON p_partkey = l_partkey
        GROUP BY p_partkey, p_name ORDER BY total_qty DESC, product_id LIMIT :k""",
    "orders_on_day": """
        SELECT count(o_orderkey) AS n_orders FROM orders
        WHERE o_orderstatus = :status AND year(o_orderdate) = :y AND month(o_orderdate) = :m
          AND day(o_orderdate) = :d""",
    "revenue_on_day": """
        SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = :status
          AND o_orderdate >= CAST(:start AS TIMESTAMP_NTZ) AND o_orderdate < CAST(:end AS TIMESTAMP_NTZ))""",
}
