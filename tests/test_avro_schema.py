"""Schemas from Avro schema documents (SRC-6, CAT-2)."""

import json
import uuid

import pytest
from pyspark.sql import types as T

from cinder import tables
from cinder.sources.avro_schema import read_schema, schema_from_avro
from cinder.sources.external import create_external_table, read_external


def record(*fields, **more):
    return json.dumps({"type": "record", "name": "r", "fields": [{"name": n, "type": t} for n, t in fields], **more})


def test_types():
    doc = record(
        ("a", "int"), ("b", ["null", "long"]), ("c", ["string", "null"]), ("d", {"type": "int", "logicalType": "date"}),
        ("e", {"type": "long", "logicalType": "timestamp-millis"}), ("f", {"type": "long", "logicalType": "local-timestamp-micros"}),
        ("g", {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 2}),
        ("h", {"type": "fixed", "name": "money", "size": 8, "logicalType": "decimal", "precision": 18, "scale": 4}), ("i", "money"),
        ("j", {"type": "array", "items": ["null", "double"]}), ("k", {"type": "map", "values": "int"}),
        ("l", ["null", {"type": "record", "name": "inner", "namespace": "x.y", "fields": [{"name": "p", "type": "boolean"}, {"name": "q", "type": {"type": "enum", "name": "s", "symbols": ["A"]}}]}]),
        ("m", "x.y.inner"), ("n", {"type": "fixed", "name": "raw", "size": 4}), ("o", ["int", "long"]), ("p", ["null", "float", "double"]),
        ("q", ["int", "null", "string"]), ("r", "null"), ("s", {"type": "string", "logicalType": "uuid"}), ("t", ["null"]), ("u", {"type": ["null", "int"]}))
    inner = T.StructType([T.StructField("p", T.BooleanType(), False), T.StructField("q", T.StringType(), False)])
    want = [T.IntegerType(), T.LongType(), T.StringType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.DecimalType(12, 2), T.DecimalType(18, 4),
            T.DecimalType(18, 4), T.ArrayType(T.DoubleType(), True), T.MapType(T.StringType(), T.IntegerType(), False), inner, inner, T.BinaryType(),
            T.LongType(), T.DoubleType(), T.StructType([T.StructField("member0", T.IntegerType()), T.StructField("member1", T.StringType())]),
            T.NullType(), T.StringType(), T.NullType(), T.IntegerType()]
    got = schema_from_avro(doc)
    assert [f.dataType for f in got] == want
    assert {f.name for f in got if f.nullable} == set("bclpqrtu")


def test_comments_and_bad_documents():
    doc = json.dumps({"type": "record", "name": "a.b.r", "fields": [{"name": "x", "type": "int", "doc": "the x"}, {"name": "y", "type": {"type": "enum", "name": "e", "symbols": []}},
                                                                    {"name": "z", "type": "a.b.e"}]})
    assert schema_from_avro(doc).fields[0].metadata == {"comment": "the x"} and schema_from_avro(doc)["z"].dataType == T.StringType()
    for bad, why in ((record(("x", "nothing")), "not defined"), (record(("x", ["null", "r"])), "recursive"), ('"int"', "no record")):
        with pytest.raises(ValueError, match=why):
            schema_from_avro(bad)


def test_tables_declared_by_document(spark, tmp_dir):
    spark.createDataFrame([(1, "a;b", 2.5)], "k int, s string, v double").write.parquet(f"{tmp_dir}/p")
    spark.createDataFrame([("1;a",)], "v string").write.text(f"{tmp_dir}/c")
    with open(f"{tmp_dir}/s.avsc", "w") as f:
        json.dump({"type": "record", "name": "t", "fields": [{"name": "k", "type": ["null", "int"], "doc": "key"}, {"name": "s", "type": ["null", "string"]},
                                                            {"name": "later", "type": ["null", "long"], "default": None}]}, f, indent=1)
    assert read_schema(spark, f"{tmp_dir}/s.avsc").names == ["k", "s", "later"]
    assert [tuple(r) for r in read_external(spark, f"{tmp_dir}/p", avro_schema_url=f"{tmp_dir}/s.avsc").collect()] == [(1, "a;b", None)]
    assert tuple(read_external(spark, f"{tmp_dir}/c", "csv", avro_schema_json=open(f"{tmp_dir}/s.avsc").read(), options={"sep": ";"}).first()) == (1, "a", None)
    name = f"x_{uuid.uuid4().hex[:12]}"
    create_external_table(spark, name, f"{tmp_dir}/c", "csv", avro_schema_url=f"{tmp_dir}/s.avsc", options={"sep": ";"}, comment="outside")
    assert tuple(spark.table(name).first()) == (1, "a", None)
    assert [tuple(r) for r in tables.describe(spark, name).collect()] == [("k", "int", "key"), ("s", "string", None), ("later", "bigint", None)]
    tables.drop_table(spark, name)
    with pytest.raises(ValueError, match="no document"):
        open(f"{tmp_dir}/empty.avsc", "w").close()
        read_schema(spark, f"{tmp_dir}/empty.avsc")
