"""Tables whose contents and columns change while others read them (SRC-7, CAT-4).

A versioned name is a view in the catalog over one version, a table of its own with a folder
of its own. A load writes a new version and then points the view at it; a column rename points
the view at the same version under another column name. Both are one catalog call, so at every
moment the name resolves to the old rows and columns or to the new ones. A load that fails
leaves the view as it was. Partitions, buckets, format, options and properties belong to the
version and are carried to the next one; comments stand in the view and the version. Filters on
partition columns and joins on bucket columns pass through the view.

A plain table becomes a versioned name by :func:`adopt`. The catalog has no call that swaps a
table for a view, so there, and only there, the name is free for a moment between two calls.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cinder.session import file_system
from cinder.tables import columns_sql, comment_sql, options_sql, quoted, quoted_name, text_literal

#: The view's property that names its version.
VERSION = "cinder.version"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {quoted_name(name)}").collect()}


def details(spark: SparkSession, name: str) -> dict[str, str]:
    """The catalog's entries about a table or view: Type, Provider, Location, Comment, ..."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_name(name)}").collect()
    at = next(i for i, r in enumerate(rows) if r.col_name == "# Detailed Table Information")
    return {r.col_name: r.data_type for r in rows[at + 1:]}


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    rows = [r.col_name for r in spark.sql(f"DESCRIBE TABLE {quoted_name(table)}").collect()]
    return rows[rows.index("# col_name") + 1:] if "# Partition Information" in rows else []


def current_version(spark: SparkSession, name: str) -> str | None:
    """The table behind a versioned name; None if the name is no versioned one."""
    if not spark.catalog.tableExists(quoted_name(name)):
        return None
    return _properties(spark, name).get(VERSION)


def _next(name: str) -> str:
    return re.sub(r"__v[0-9a-f]{32}$", "", name) + f"__v{uuid.uuid4().hex}"


def _point(spark: SparkSession, name: str, version: str, columns: list[str], comment: str | None) -> None:
    """The one step that makes a version, under these column names, what ``name`` shows."""
    fields = spark.table(quoted_name(version)).schema.fields
    shown = ", ".join(quoted(c) + comment_sql(f.metadata.get("comment")) for c, f in zip(columns, fields, strict=True))
    picked = ", ".join(quoted(f.name) for f in fields)
    spark.sql(f"CREATE OR REPLACE VIEW {quoted_name(name)} ({shown}){comment_sql(comment)} "
              f"TBLPROPERTIES ({text_literal(VERSION)} = {text_literal(version)}) AS SELECT {picked} FROM {quoted_name(version)}")


def _drop_version(spark: SparkSession, version: str, delete: bool = True) -> None:
    """Drop a version. Managed ones lose their folder with it; of others it is deleted here, unless it was not ours."""
    about = details(spark, version)
    spark.sql(f"DROP TABLE IF EXISTS {quoted_name(version)}")
    if delete and about["Type"] == "EXTERNAL":
        fs, path = file_system(spark, about["Location"])
        fs.delete(path, True)


def create_versioned(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet", *, partitioned_by: tuple[str, ...] = (),
                     bucketed_by: tuple[str, ...] = (), sorted_by: tuple[str, ...] = (), buckets: int = 0, comment: str | None = None,
                     options: dict | None = None, location: str | None = None) -> None:
    """An empty versioned table. Its versions stand in folders of their own under ``location``, or in the warehouse."""
    version = _next(name)
    names = lambda cs: ", ".join(map(quoted, cs))
    layout = f" PARTITIONED BY ({names(partitioned_by)})" if partitioned_by else ""
    if bucketed_by:
        layout += f" CLUSTERED BY ({names(bucketed_by)}){f' SORTED BY ({names(sorted_by)})' if sorted_by else ''} INTO {buckets} BUCKETS"
    place = f" LOCATION {text_literal(_folder(location, version))}" if location else ""
    spark.sql(f"CREATE TABLE {quoted_name(version)}{columns_sql(schema)} USING {fmt}{options_sql(options)}{layout}{place}{comment_sql(comment)}")
    _point(spark, name, version, spark.table(quoted_name(version)).columns, comment)


def _folder(location: str, version: str) -> str:
    return f"{location.rstrip('/')}/{version.split('.')[-1]}"


def like(spark: SparkSession, table: str, new: str, location: str | None = None) -> None:
    """An empty table with another one's columns, partitions, buckets, format, options, properties and comment."""
    place = f" LOCATION {text_literal(location)}" if location else ""
    kept = {k: v for k, v in _properties(spark, table).items() if k != "comment" and not k.startswith("transient")}
    pairs = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in kept.items())
    spark.sql(f"CREATE TABLE {quoted_name(new)} LIKE {quoted_name(table)}{place}{f' TBLPROPERTIES ({pairs})' if pairs else ''}")
    comment = details(spark, table).get("Comment")
    if comment:
        spark.sql(f"COMMENT ON TABLE {quoted_name(new)} IS {text_literal(comment)}")


def _insert(df: DataFrame, table: str, shown: list[str]) -> None:
    """Rows by column name where the names are the table's, else by position."""
    if sorted(df.columns) == sorted(shown):
        df = df.select(*map(quoted, shown))
    df.write.insertInto(quoted_name(table))


def replace_contents(df: DataFrame, name: str, keep_old: bool = False) -> None:
    """Replace a versioned name's rows with ``df``, which may read the name itself.

    The old version is dropped at the end, unless a reader that is under way should keep it (``keep_old``).
    """
    spark = df.sparkSession
    old = current_version(spark, name)
    if old is None:
        raise ValueError(f"{name} is no versioned table")
    shown, about = spark.table(quoted_name(name)).columns, details(spark, old)
    new = _next(name)
    external = about["Type"] == "EXTERNAL"
    like(spark, old, new, _folder(about["Location"].rstrip("/").rsplit("/", 1)[0], new) if external else None)
    try:
        _insert(df, new, shown)
        _point(spark, name, new, shown, details(spark, name).get("Comment"))
    except BaseException:
        _drop_version(spark, new)
        raise
    if not keep_old:
        _drop_version(spark, old, delete=_ours(old, about))


def _ours(version: str, about: dict[str, str]) -> bool:
    """Whether a version's folder was made for it: an adopted external table's was not."""
    return about["Type"] != "EXTERNAL" or about["Location"].rstrip("/").endswith(version.split(".")[-1])


def append(df: DataFrame, name: str) -> None:
    """Add rows to a versioned name's current version."""
    spark = df.sparkSession
    _insert(df, current_version(spark, name), spark.table(quoted_name(name)).columns)


def rename_column(spark: SparkSession, name: str, old: str, new: str) -> None:
    """CAT-4: the column's new name lasts and no row is rewritten."""
    shown = spark.table(quoted_name(name)).columns
    if old not in shown or new in shown:
        raise ValueError(f"{name}: cannot rename {old} to {new}, its columns are {shown}")
    _point(spark, name, current_version(spark, name), [new if c == old else c for c in shown], details(spark, name).get("Comment"))


def rename(spark: SparkSession, name: str, new: str) -> None:
    spark.sql(f"ALTER VIEW {quoted_name(name)} RENAME TO {quoted_name(new)}")


def drop(spark: SparkSession, name: str) -> None:
    """Drop a versioned name and its version."""
    version = current_version(spark, name)
    spark.sql(f"DROP VIEW IF EXISTS {quoted_name(name)}")
    if version:
        _drop_version(spark, version, delete=_ours(version, details(spark, version)))


def adopt(spark: SparkSession, name: str) -> None:
    """Make a plain table a versioned name: the table becomes its first version. Between the two calls the name is free."""
    version, comment = _next(name), details(spark, name).get("Comment")
    spark.sql(f"ALTER TABLE {quoted_name(name)} RENAME TO {quoted_name(version)}")
    _point(spark, name, version, spark.table(quoted_name(version)).columns, comment)


def describe_columns(spark: SparkSession, name: str) -> DataFrame:
    """DESCRIBE as rows: (position, col_name, data_type, comment, is_partition) by the names shown."""
    version = current_version(spark, name) or name
    split = set(partition_columns(spark, version))
    inner = spark.table(quoted_name(version)).columns
    rows = spark.sql(f"DESCRIBE TABLE {quoted_name(name)}").collect()[:len(inner)]
    return spark.createDataFrame([(i, r.col_name, r.data_type, r.comment, c in split) for i, (r, c) in enumerate(zip(rows, inner))],
                                 "position int, col_name string, data_type string, comment string, is_partition boolean")
