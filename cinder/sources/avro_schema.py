"""Schemas kept as Avro schema documents outside the table (SRC-6, CAT-2).

``schema_from_avro`` turns a document into a Spark schema, so that a table whose schema stands
in a file of its own can be read in any installed format. Types map as Spark's Avro reader maps
them: a union with null is a nullable field, int with long is long, float with double is double,
any other union a struct of one member a branch; named types may be used again by name.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Avro's primitive types, and its logical types by the type they annotate.
PRIMITIVE = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
             "bytes": T.BinaryType(), "string": T.StringType(), "null": T.NullType()}
LOGICAL = {("int", "date"): T.DateType(), ("long", "timestamp-millis"): T.TimestampType(), ("long", "timestamp-micros"): T.TimestampType(),
           ("long", "local-timestamp-millis"): T.TimestampNTZType(), ("long", "local-timestamp-micros"): T.TimestampNTZType()}


class _Reader:
    def __init__(self):
        self.named: dict[str, object] = {}  # full name -> definition, None while it is being read

    def type_of(self, doc, space: str) -> tuple[T.DataType, bool]:
        """The Spark type of a schema and whether it may be null."""
        if isinstance(doc, list):
            return self.union(doc, space)
        if isinstance(doc, str):
            if doc in PRIMITIVE:
                return PRIMITIVE[doc], doc == "null"
            full = doc if "." in doc else f"{space}.{doc}" if space else doc
            if self.named.get(full) is None:
                raise ValueError(f"type {doc} is " + ("recursive" if full in self.named else "not defined"))
            return self.named[full], False
        kind = doc["type"]
        if isinstance(kind, (list, dict)):
            return self.type_of(kind, space)
        if kind in ("record", "enum", "fixed"):
            return self.defined(doc, kind, space), False
        if kind == "array":
            inner, null = self.type_of(doc["items"], space)
            return T.ArrayType(inner, null), False
        if kind == "map":
            inner, null = self.type_of(doc["values"], space)
            return T.MapType(T.StringType(), inner, null), False
        if kind == "bytes" and doc.get("logicalType") == "decimal":
            return T.DecimalType(doc["precision"], doc.get("scale", 0)), False
        return LOGICAL.get((kind, doc.get("logicalType"))) or self.type_of(kind, space)[0], kind == "null"

    def defined(self, doc: dict, kind: str, space: str) -> T.DataType:
        name = doc["name"]
        space = name.rpartition(".")[0] or doc.get("namespace", space)
        full = f"{space}.{name.rpartition('.')[2]}" if space else name
        self.named[full] = None
        if kind == "record":
            fields = []
            for f in doc["fields"]:
                inner, null = self.type_of(f["type"], space)
                fields.append(T.StructField(f["name"], inner, null, {"comment": f["doc"]} if f.get("doc") else {}))
            out: T.DataType = T.StructType(fields)
        elif kind == "enum":
            out = T.StringType()
        else:
            out = T.DecimalType(doc["precision"], doc.get("scale", 0)) if doc.get("logicalType") == "decimal" else T.BinaryType()
        self.named[full] = out
        return out

    def union(self, doc: list, space: str) -> tuple[T.DataType, bool]:
        branches = [self.type_of(b, space)[0] for b in doc if b not in ("null", {"type": "null"})]
        null = len(branches) < len(doc)
        if not branches:
            return T.NullType(), True
        if len(branches) == 1:
            return branches[0], null
        kinds = set(branches)
        if kinds == {T.IntegerType(), T.LongType()}:
            return T.LongType(), null
        if kinds == {T.FloatType(), T.DoubleType()}:
            return T.DoubleType(), null
        return T.StructType([T.StructField(f"member{i}", b, True) for i, b in enumerate(branches)]), null


def schema_from_avro(document: str) -> T.StructType:
    """The Spark schema of an Avro schema document, which must be a record."""
    out, _ = _Reader().type_of(json.loads(document), "")
    if not isinstance(out, T.StructType):
        raise ValueError("the document's schema is no record")
    return out


def read_schema(spark: SparkSession, url: str) -> T.StructType:
    """The Spark schema of the document at a path that Spark reads."""
    rows = spark.read.text(url, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{url} holds {'several documents' if rows else 'no document'}")
    return schema_from_avro(rows[0].value)
