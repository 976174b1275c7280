"""Loads and renames that others can read through (SRC-7, CAT-4)."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinder import tables, versioned
from cinder.sources.external import create_external_table, overwrite_load

SCHEMA = T.StructType([T.StructField("k", T.LongType(), True, {"comment": "the key"}), T.StructField("level", T.StringType()),
                       T.StructField("day", T.StringType())])


@pytest.fixture()
def name(spark):
    name = f"t_{uuid.uuid4().hex[:12]}"
    yield name
    for t in [r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith(name)]:
        tables.drop_table(spark, t) if spark.catalog.tableExists(t) else None


def rows_of(spark, table):
    return sorted(map(tuple, spark.table(table).collect()))


def frame(spark, rows, schema="k long, level string, day string"):
    return spark.createDataFrame(rows, schema)


def failing(spark):
    """Rows whose second partition fails after the first was written."""
    boom = F.when(F.col("id") < 2, F.lit("x")).otherwise(F.raise_error(F.lit("half-way")).cast("string"))
    return spark.range(0, 4, 1, 2).select(F.col("id").alias("k"), boom.alias("level"), F.lit("d").alias("day"))


def versions(spark, name):
    return [r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith(f"{name}__v")]


@pytest.mark.parametrize("kind", ["plain", "external", "partitioned", "versioned"])
def test_load_is_whole_or_nothing(spark, name, tmp_dir, kind):
    if kind == "versioned":
        versioned.create_versioned(spark, name, SCHEMA, partitioned_by=("day",), comment="c", location=tmp_dir)
    elif kind == "external":
        spark.range(0).selectExpr("id AS k", "'a' AS level", "'b' AS day").write.parquet(f"{tmp_dir}/own")
        create_external_table(spark, name, f"{tmp_dir}/own", schema=SCHEMA)
    else:
        spark.sql(f"CREATE TABLE {name} (k BIGINT, level STRING, day STRING) USING parquet {'PARTITIONED BY (day)' if kind == 'partitioned' else ''} COMMENT 'c'")
    overwrite_load(frame(spark, [(1, "a", "x"), (2, "b", "y")]), name)
    assert rows_of(spark, name) == [(1, "a", "x"), (2, "b", "y")]
    with pytest.raises(Exception, match="half-way"):
        overwrite_load(failing(spark), name)
    assert rows_of(spark, name) == [(1, "a", "x"), (2, "b", "y")]
    # reads its own table
    overwrite_load(spark.table(name).where("k > 1").unionByName(spark.table(name).selectExpr("k + 10 AS k", "level", "day")), name)
    assert rows_of(spark, name) == [(2, "b", "y"), (11, "a", "x"), (12, "b", "y")]
    overwrite_load(spark.table(name).where("false"), name)
    assert rows_of(spark, name) == []
    assert len(versions(spark, name)) == (kind in ("partitioned", "versioned"))
    if kind == "external":
        assert os.path.exists(f"{tmp_dir}/own")  # the declared folder is left alone
    assert not [t.tableName for t in spark.sql("SHOW TABLES").collect() if t.tableName.startswith(f"{name}__load")]
    place = versioned.details(spark, versioned.current_version(spark, name) or name)["Location"].removeprefix("file:")
    tables.drop_table(spark, name)
    assert kind == "external" or not os.path.exists(place)


def test_a_reader_keeps_its_version(spark, name, tmp_dir):
    versioned.create_versioned(spark, name, SCHEMA, location=tmp_dir)
    versioned.append(frame(spark, [(1, "a", "x")]), name)
    reader = spark.table(name)
    versioned.replace_contents(frame(spark, [(2, "b", "y")]), name, keep_old=True)
    assert [tuple(r) for r in reader.collect()] == [(1, "a", "x")] and rows_of(spark, name) == [(2, "b", "y")]


def test_rename_keeps_the_table(spark, name, tmp_dir):
    versioned.create_versioned(spark, name, SCHEMA, partitioned_by=("day",), bucketed_by=("k",), sorted_by=("k",), buckets=3,
                               comment="it's kept", options={"compression": "zstd"}, location=tmp_dir)
    overwrite_load(frame(spark, [(1, "a", "x"), (2, "b", "y")]), name)
    before = versioned.current_version(spark, name)
    tables.rename_column(spark, name, "level", "status")
    tables.rename_column(spark, name, "day", "on_day")
    assert versioned.current_version(spark, name) == before  # nothing was rewritten
    assert spark.table(name).columns == ["k", "status", "on_day"]
    overwrite_load(spark.table(name).withColumn("status", F.upper("status")), name)  # and it lasts
    assert rows_of(spark, name) == [(1, "A", "x"), (2, "B", "y")]
    after = versioned.current_version(spark, name)
    assert after != before and versions(spark, name) == [after]
    about, shown = versioned.details(spark, after), versioned.details(spark, name)
    assert (about["Num Buckets"], about["Bucket Columns"], about["Sort Columns"]) == ("3", "[`k`]", "[`k`]")
    assert about["Comment"] == shown["Comment"] == "it's kept" and "compression=zstd" in about["Storage Properties"]
    assert versioned.partition_columns(spark, after) == ["day"]
    got = [tuple(r) for r in versioned.describe_columns(spark, name).collect()]
    assert got == [(0, "k", "bigint", "the key", False), (1, "status", "string", None, False), (2, "on_day", "string", None, True)]
    plan = spark.table(name).where("on_day = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    with pytest.raises(ValueError):
        tables.rename_column(spark, name, "gone", "x")
    tables.rename_table(spark, name, f"{name}_b")
    assert rows_of(spark, f"{name}_b") == [(1, "A", "x"), (2, "B", "y")]
    tables.drop_table(spark, f"{name}_b")
    tables.drop_table(spark, f"{name}_b")
    assert not versions(spark, name) and os.listdir(tmp_dir) == []


def test_rename_of_a_plain_table_moves_no_row(spark, name, tmp_dir):
    spark.createDataFrame([(1, "a", "x")], "k long, level string, day string").write.parquet(f"{tmp_dir}/own")
    create_external_table(spark, name, f"{tmp_dir}/own", schema=SCHEMA, comment="outside")
    files = sorted(os.listdir(f"{tmp_dir}/own"))
    tables.rename_column(spark, name, "level", "status")
    assert rows_of(spark, name) == [(1, "a", "x")] and spark.table(name).columns == ["k", "status", "day"]
    about = versioned.details(spark, versioned.current_version(spark, name))
    assert about["Type"] == "EXTERNAL" and about["Location"].endswith("/own") and about["Comment"] == "outside"
    tables.drop_table(spark, name)
    assert sorted(os.listdir(f"{tmp_dir}/own")) == files  # external data is not deleted


def test_the_name_resolves_at_every_step(spark, name, tmp_dir, monkeypatch):
    """Every catalog call of a load and of a rename leaves a name that shows whole rows."""
    versioned.create_versioned(spark, name, SCHEMA, location=tmp_dir)
    overwrite_load(frame(spark, [(1, "a", "x")]), name)
    seen, sql = [], type(spark).sql

    def watched(self, text, *args, **kwargs):
        out = sql(self, text, *args, **kwargs)
        seen.append(sorted(map(tuple, spark.table(name).collect())))
        return out
    monkeypatch.setattr(type(spark), "sql", watched)
    overwrite_load(frame(spark, [(2, "b", "y")]), name)
    tables.rename_column(spark, name, "level", "status")
    monkeypatch.undo()
    assert len(seen) > 5 and {tuple(s) for s in seen} == {((1, "a", "x"),), ((2, "b", "y"),)}
    assert seen == sorted(seen)
