"""Nested rows (loyalty table): map / array / struct access and column rename
(NST-1..3, FLT-10, CAT-4/6). Each lookup runs over the whole table; pass a
``cust_id`` for the point lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinder.functions.nested import array_at, map_value, struct_field


def _point(df: DataFrame, cust_id: int | None) -> DataFrame:
    return df if cust_id is None else df.where(F.col("cust_id") == cust_id)


def map_lookup(loyalty: DataFrame, key: str = "HOME", cust_id: int | None = None) -> DataFrame:
    return _point(loyalty, cust_id).select("cust_id", map_value(F.col("phone"), key).alias("home_phone"))


def array_element(df: DataFrame, id_col: str, array_col: str, index0: int) -> DataFrame:
    """(id, element): the array's element at a zero-based index, NULL past its end."""
    return df.select(id_col, array_at(F.col(array_col), index0).alias("element"))


def json_map_lookup(df: DataFrame, id_col: str, json_col: str, key: str) -> DataFrame:
    """(id, value) of a key in a map parsed from JSON text; NULL without the key or for bad JSON."""
    parsed = F.from_json(F.col(json_col), "map<string,string>", {"mode": "PERMISSIVE"})
    return df.select(id_col, map_value(parsed, key).alias("value"))


def struct_lookup(loyalty: DataFrame, field: str = "total", cust_id: int | None = None) -> DataFrame:
    return _point(loyalty, cust_id).select("cust_id", struct_field(F.col("order_value"), field).alias("order_total"))


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """CAT-4: the session catalog has no Hive ``CHANGE``; rename in the plan
    (then write it back or define a view). Data is unchanged (CAT-6)."""
    return df.withColumnRenamed(old, new)


def point_lookup(loyalty: DataFrame, cust_id: int | None = None) -> DataFrame:
    """FLT-10: one customer's phone, order total and level (of all rows without ``cust_id``)."""
    return _point(loyalty, cust_id).select(
        "cust_id", map_value(F.col("phone"), "HOME").alias("home_phone"),
        struct_field(F.col("order_value"), "total").alias("order_total"), "level")
