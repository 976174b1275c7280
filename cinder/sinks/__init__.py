"""Writers: tuple text, key<TAB>value text, hash-sharded sorted output, stamped
output folders and the combined report (SNK-1..5)."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _text(col: str) -> F.Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def tuple_lines(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """'(a,b,c)' per row, as tuples print; a NULL field is empty but stays."""
    cols = cols or df.columns
    return df.select(F.concat(F.lit("("), F.concat_ws(",", *map(_text, cols)), F.lit(")")).alias("value"))


def key_value_lines(df: DataFrame, key: str, value: str) -> DataFrame:
    """'key<TAB>value' per row, both as they are: no quoting, nothing escaped, NULL empty."""
    return df.select(F.concat(_text(key), F.lit("\t"), _text(value)).alias("value"))


def write_tuples(df: DataFrame, path: str, cols: list[str] | None = None, mode: str = "errorifexists") -> None:
    """SNK-1: one '(a,b,...)' text line per row, one file per partition."""
    tuple_lines(df, cols).write.mode(mode).text(path)


def write_key_value(df: DataFrame, path: str, key: str, value: str, mode: str = "errorifexists") -> None:
    """SNK-2: 'key<TAB>value' lines."""
    key_value_lines(df, key, value).write.mode(mode).text(path)


def write_sharded(df: DataFrame, path: str, key: str, shards: int, value: str | None = None,
                  mode: str = "errorifexists") -> None:
    """SNK-3: ``shards`` output files, rows placed by a hash of ``key`` and each
    file sorted by key. (Shard placement uses Spark's hash; what a key maps to
    is stable, the exact shard differs from other engines.)"""
    value = value or next(c for c in df.columns if c != key)
    out = df.repartition(shards, key).sortWithinPartitions(key)
    key_value_lines(out, key, value).write.mode(mode).text(path)


def stamped_path(base: str, millis: int | None = None) -> str:
    """SNK-4: '<base>_<epoch millis>' so each run writes a new folder."""
    return f"{base}_{millis if millis is not None else int(time.time() * 1000)}"


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """SNK-5: the combined report, written by the executors (nothing collected)."""
    report.write.mode(mode).parquet(path)
