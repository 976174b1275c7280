"""Table lifecycle in the session catalog (CAT-1..7, MEM-1): data-source tables,
no Hive mode needed. Every name is quoted and every text escaped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def text_literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def quoted_name(name: str) -> str:
    """A table name, its parts (database.table) quoted one by one."""
    return ".".join(quoted(p) for p in name.split("."))


def columns_sql(schema: T.StructType | None) -> str:
    return "" if schema is None else " (" + ", ".join(
        f"{quoted(f.name)} {f.dataType.simpleString()}{comment_sql(f.metadata.get('comment'))}" for f in schema.fields) + ")"


def options_sql(options: dict | None) -> str:
    pairs = [f"{text_literal(str(k))} {text_literal(str(v))}" for k, v in (options or {}).items()]
    return f" OPTIONS ({', '.join(pairs)})" if pairs else ""


def comment_sql(comment: str | None) -> str:
    return f" COMMENT {text_literal(comment)}" if comment else ""


def create_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet",
                 comment: str | None = None, options: dict | None = None) -> None:
    """CAT-1: ``CREATE TABLE IF NOT EXISTS name (cols) USING fmt [OPTIONS] [COMMENT]``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted_name(name)}{columns_sql(schema)} USING {fmt}{options_sql(options)}{comment_sql(comment)}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    """CAT-3: (col_name, data_type, comment)."""
    return spark.sql(f"DESCRIBE TABLE {quoted_name(name)}")


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """CAT-5."""
    from cinder import versioned

    if versioned.current_version(spark, old):
        return versioned.rename(spark, old, new)
    spark.sql(f"ALTER TABLE {quoted_name(old)} RENAME TO {quoted_name(new)}")


def _renamed_columns(spark: SparkSession, table: str, old: str, new: str) -> str:
    return ", ".join(quoted(c) if c != old else f"{quoted(old)} AS {quoted(new)}" for c in spark.table(quoted_name(table)).columns)


def rename_column(spark: SparkSession, table: str, old: str, new: str) -> None:
    """CAT-4 that lasts, without rewriting a row: the name becomes a view of the catalog over the table as it is, with its
    partitions, buckets, options, comments and folder (see :mod:`cinder.versioned`)."""
    from cinder import versioned

    if not versioned.current_version(spark, table):
        versioned.adopt(spark, table)
    versioned.rename_column(spark, table, old, new)


def rename_column_as_view(spark: SparkSession, table: str, old: str, new: str, view: str, lasting: bool = False) -> None:
    """CAT-4 without touching the data: a view exposing ``old`` as ``new``, of the session or kept in the catalog."""
    kind = "VIEW" if lasting else "TEMP VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {quoted_name(view)} AS SELECT {_renamed_columns(spark, table, old, new)} FROM {quoted_name(table)}")


def drop_table(spark: SparkSession, name: str) -> None:
    """CAT-7: safe to repeat."""
    from cinder import versioned

    if versioned.current_version(spark, name):
        return versioned.drop(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {quoted_name(name)}")
