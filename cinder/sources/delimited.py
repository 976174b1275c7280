"""SRC-2/3/4: delimited records held in a ``value`` column (one per text line).

Lines are parsed with Spark's own CSV parser (``from_csv``), so quoting works the
same whether the lines come from a file (``spark.read.text``) or from a derived
column. The record width is counted with the quote-aware split, which is what
the width check needs: the CSV parser pads short rows with NULLs and drops the
tail of long ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A quoted run of the reversed line, up to its closing quote or the line's start. What a comma
# stands outside of from the right is what the width check counts.
QUOTED_RUN = '"[^"]*("|$)'

CORRUPT_COL = "_corrupt_record"

HIVE_NULL = "\\N"

# The ratings table's columns and types (tab-separated text).
RATINGS_SCHEMA = T.StructType([
    T.StructField("posted", T.TimestampNTZType()),
    T.StructField("cust_id", T.IntegerType()),
    T.StructField("prod_id", T.IntegerType()),
    T.StructField("rating", T.ByteType()),
    T.StructField("message", T.StringType()),
])


def token_count(line: Column) -> Column:
    """Number of comma-separated fields, trailing empty ones included: one more than the commas that an even
    number of quotes follows. One pass over the line, whatever its quotes."""
    outside = F.regexp_replace(F.reverse(line), QUOTED_RUN, "")
    return F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1


def parse_delimited(
    lines: DataFrame,
    schema: T.StructType,
    *,
    sep: str = ",",
    line_col: str = "value",
    keep_line: bool = False,
    options: dict | None = None,
) -> DataFrame:
    """Parse each line into ``schema`` columns (PERMISSIVE: bad fields become NULL).

    Adds ``_malformed`` (the parser saw a short/unparsable record). Quotes are
    stripped as a CSV reader does.
    """
    parse_schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])
    opts = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT_COL, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    opts.update(options or {})
    parsed = F.from_csv(F.col(line_col), parse_schema.simpleString(), opts)
    # inline(array(struct)) parses once per line: a Generate is a barrier for
    # filter push-down, so later predicates on the fields do not re-run the parser.
    extra = [F.col(line_col).alias("line")] if keep_line else []
    out = lines.select(*extra, F.inline(F.array(parsed)))
    cols = [f.name for f in schema.fields]
    return out.select(*cols, F.col(CORRUPT_COL).isNotNull().alias("_malformed"), *(["line"] if keep_line else []))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, *, sep: str = ",", **kw) -> DataFrame:
    """File form: read lines, then parse them with :func:`parse_delimited`."""
    return parse_delimited(spark.read.text(path), schema, sep=sep, **kw)


def parse_hive_text(lines: DataFrame, schema: T.StructType, *, sep: str = "\t", line_col: str = "value") -> DataFrame:
    """Fields of a text table by Hive's rules: no quoting, ``\\N`` is NULL, a blank STRING stays ''.

    Missing, out-of-range or unparsable fields become NULL; the rest of the row is kept.
    """
    parts = lines.select(F.split(F.col(line_col), f"\\Q{sep}\\E", -1).alias("_p"))

    def field(i: int, f: T.StructField) -> Column:
        text = F.nullif(F.get("_p", i), F.lit(HIVE_NULL))
        return (text if isinstance(f.dataType, T.StringType) else text.try_cast(f.dataType)).alias(f.name)
    return parts.select(*[field(i, f) for i, f in enumerate(schema.fields)])


def read_typed_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-4: tab-delimited typed table (``FIELDS TERMINATED BY '\\t'``) in files."""
    return parse_hive_text(spark.read.text(path), schema)
