"""SRC-6 / SRC-7: external tables with a declared schema and overwrite loads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cinder.session import file_system
from cinder.sources.avro_schema import read_schema, schema_from_avro
from cinder.tables import columns_sql, comment_sql, options_sql, quoted_name, text_literal


def read_external(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    *,
    schema=None,
    avro_schema_json: str | None = None,
    avro_schema_url: str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Scan an external table in any data-source format.

    ``avro_schema_json`` or ``avro_schema_url`` give a schema kept outside the table. The ``avro`` format,
    which needs the spark-avro package on the classpath, takes the document itself; for any other
    format it is turned into a Spark schema. Columns that a file lacks are NULL.
    """
    reader = spark.read.format(fmt)
    if schema is None and fmt != "avro" and (avro_schema_json or avro_schema_url):
        schema = schema_from_avro(avro_schema_json) if avro_schema_json else read_schema(spark, avro_schema_url)
    if schema is not None:
        reader = reader.schema(schema)
    elif avro_schema_json is not None:
        reader = reader.option("avroSchema", avro_schema_json)
    elif avro_schema_url is not None:
        reader = reader.option("avroSchemaUrl", avro_schema_url)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


def create_external_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet", if_not_exists: bool = True, *,
                          schema: T.StructType | None = None, avro_schema_url: str | None = None, options: dict | None = None,
                          comment: str | None = None) -> None:
    """CAT-2: ``CREATE TABLE ... USING fmt OPTIONS (...) LOCATION path`` (data stays where it is).

    ``avro_schema_url`` names a schema document: Avro reads it by itself, for other formats its columns are declared.
    Without either the format infers the schema.
    """
    if schema is None and avro_schema_url and fmt != "avro":
        schema, avro_schema_url = read_schema(spark, avro_schema_url), None
    every = {**({"avroSchemaUrl": avro_schema_url} if avro_schema_url else {}), **(options or {})}
    spark.sql(f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}{quoted_name(name)}{columns_sql(schema)} USING {fmt}"
              f"{options_sql(every)} LOCATION {text_literal(path)}{comment_sql(comment)}")


def overwrite_load(df: DataFrame, table: str) -> None:
    """SRC-7: replace a table's contents with ``df`` (``LOAD DATA ... OVERWRITE``), which may read the table itself.

    The rows are written to a fresh folder as the table would hold them, then one catalog call makes it the
    table's folder: readers see all old rows or all new ones, and a load that fails leaves the old ones. The
    old folder is deleted, but for the one an external table was declared on. A versioned name, and a table
    whose partitions the catalog lists one by one (it is adopted), get a new version instead.
    """
    from cinder import versioned

    spark = df.sparkSession
    about = versioned.details(spark, table)
    if about.get("Partition Provider") == "Catalog" and not versioned.current_version(spark, table):
        versioned.adopt(spark, table)
    if versioned.current_version(spark, table):
        return versioned.replace_contents(df, table)
    mark, fresh = f"__load{uuid.uuid4().hex}", f"{table}__load{uuid.uuid4().hex}"
    old = about["Location"].rstrip("/")
    new = old.split("__load")[0] + mark
    versioned.like(spark, table, fresh, new)
    try:
        df.write.insertInto(quoted_name(fresh))
        spark.sql(f"ALTER TABLE {quoted_name(table)} SET LOCATION {text_literal(new)}")
    except BaseException:
        fs, path = file_system(spark, new)
        fs.delete(path, True)
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {quoted_name(fresh)}")  # external: its folder stays
    spark.catalog.refreshTable(quoted_name(table))
    if about["Type"] == "MANAGED" or "__load" in old:
        fs, path = file_system(spark, old)
        fs.delete(path, True)
