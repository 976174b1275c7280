"""Exchange-listing screener (SRC-2, FLT-2..6, STR-2..5, NUM-3, AGG-2..4, AGG-11, FMT-2).

Input: listing lines, quoted CSV with 9 fields per record (symbol, name, last
sale, market cap, IPO year, sector, industry, summary URL, trailing empty).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinder.functions.formatting import currency
from cinder.functions.numbers import cap_unit, cap_usd
from cinder.functions.text import ieq
from cinder.operators.numbering import number_rows
from cinder.sources.delimited import parse_delimited, token_count

TOTAL = "decimal(38,2)"

# The listing's fields in file order, and its record width.
LISTING_FIELDS = ["symbol", "name", "last_sale", "market_cap", "ipo_year", "sector", "industry",
                  "summary_quote", "extra"]
LISTING_WIDTH = 9
LISTING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in LISTING_FIELDS])


def parse_listing(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Every line with its fields, ``is_header`` (FLT-2), ``bad_width`` (FLT-6:
    the parser did not find exactly 9 fields, or the line is blank) and
    ``n_tokens``. The quote-aware field count is only computed for bad rows;
    a good row has 9 fields by definition."""
    parsed = parse_delimited(lines.select(F.col(line_col).alias("value")), LISTING_SCHEMA, keep_line=True)
    bad = F.col("_malformed") | (F.col("line") == "")
    return parsed.select(
        *LISTING_FIELDS,
        "line",
        bad.alias("bad_width"),
        F.when(bad, token_count(F.col("line"))).otherwise(F.lit(LISTING_WIDTH)).alias("n_tokens"),
        F.coalesce(ieq(F.col("symbol"), "symbol") | ieq(F.col("sector"), "sector"), F.lit(False)).alias("is_header"),
    )


def listing_records(parsed: DataFrame) -> DataFrame:
    """Data records of the right width (FLT-6), header(s) removed."""
    return parsed.where(~F.col("is_header") & ~F.col("bad_width")).select(*LISTING_FIELDS[:-1])


def listing_rejects(parsed: DataFrame) -> DataFrame:
    """Records of the wrong width (short, over-long or blank): the line and its width."""
    return parsed.where(~F.col("is_header") & F.col("bad_width")).select("line", "n_tokens")


def cap_normalize(records: DataFrame) -> DataFrame:
    """(symbol, market_cap, cap_unit, cap_usd): units from the actual suffix."""
    return records.select(
        "symbol", "market_cap", cap_unit("market_cap").alias("cap_unit"),
        cap_usd("market_cap").alias("cap_usd"),
    )


def cap_rejects(records: DataFrame) -> DataFrame:
    """(symbol, market_cap) of records whose cap is neither an amount nor n/a; no screen counts or sums them."""
    return records.where(cap_usd("market_cap").isNull()).select("symbol", "market_cap")


def _screened(records: DataFrame, billion: bool, known_sectors_only: bool) -> DataFrame:
    is_b = F.coalesce(F.col("market_cap").endswith("B"), F.lit(False))
    out = records.where(is_b if billion else ~is_b)
    if known_sectors_only:
        out = out.where(~ieq(F.col("sector"), "n/a"))
    return out.withColumn("cap_usd", cap_usd("market_cap")).where(F.col("cap_usd").isNotNull())


def screen(records: DataFrame, billion: bool = False, known_sectors_only: bool = False) -> DataFrame:
    """Per sector: company count and total cap (AGG-2/3), billion or non-billion caps.

    ``known_sectors_only`` drops the unknown ('n/a') sector (FLT-3)."""
    return (
        _screened(records, billion, known_sectors_only)
        .groupBy("sector")
        .agg(F.count(F.lit(1)).alias("company_count"), F.sum("cap_usd").cast(TOTAL).alias("total_cap"))
    )


def screen_formatted(records: DataFrame, billion: bool = False) -> DataFrame:
    """Report text: 'Sector: X', count, cap as currency with separators (FMT-2)."""
    return screen(records, billion).select(
        F.concat(F.lit("Sector: "), F.col("sector")).alias("sector_label"),
        "company_count",
        currency(F.col("total_cap")).alias("total_market_cap"),
    )


def screen_symbols(records: DataFrame, billion: bool = False, chunk_size: int = 1000) -> DataFrame:
    """Per sector the comma-joined symbols in order (AGG-4).

    A sector's list is cut into parts of ``chunk_size`` symbols so that no single
    string (and no aggregation buffer) grows with the sector: rows are numbered
    within their sector (distributed numbering), and each part is one small
    ordered ``listagg``. Concatenating the parts in ``part`` order gives the
    full list.
    """
    numbered = number_rows(_screened(records, billion, False).select("sector", "symbol"),
                           ["symbol"], ["sector"])
    return (
        numbered.withColumn("part", F.floor((F.col("row_no") - 1) / chunk_size).cast("int"))
        .groupBy("sector", "part")
        .agg(F.expr("listagg(symbol, ', ') WITHIN GROUP (ORDER BY symbol)").alias("symbols"),
             F.count(F.lit(1)).alias("n_symbols"))
    )


def screen_symbol_rows(records: DataFrame, billion: bool = False) -> DataFrame:
    """AGG-4 as rows: (sector, position, symbol), the symbol's place in its
    sector's ordered list. Nothing is concatenated, so no value grows with a
    sector; ``screen_symbols`` is the same list joined into bounded parts."""
    return number_rows(_screened(records, billion, False).select("sector", "symbol"),
                       ["symbol"], ["sector"], name="position")


def screen_counters(parsed: DataFrame, billion: bool = False) -> DataFrame:
    """Job counters in one pass (AGG-11): per sector and in total (sector NULL),
    data records attempted and records that passed the screen."""
    data = parsed.where(~F.col("is_header"))
    is_b = F.coalesce(F.col("market_cap").endswith("B"), F.lit(False))
    passed = ~F.col("bad_width") & (is_b if billion else ~is_b) & cap_usd("market_cap").isNotNull()
    # the few sector rows are rolled up, not the data
    per_sector = data.groupBy("sector").agg(F.count(F.lit(1)).alias("_a"), F.count_if(passed).alias("_p"))
    return per_sector.rollup("sector").agg(
        F.grouping("sector").cast("boolean").alias("is_total"),
        F.coalesce(F.sum("_a"), F.lit(0)).alias("attempted"),
        F.coalesce(F.sum("_p"), F.lit(0)).alias("processed"),
    )


def screen_observed(parsed: DataFrame, billion: bool = False):
    """The screen plus its job counters as a by-product of the same job (AGG-11).

    Returns ``(screen_df, observation)``; after ``screen_df`` runs (e.g. is
    written), ``observation.get`` holds attempted / processed counts. Only
    those few numbers reach the driver.
    """
    from pyspark.sql import Observation

    obs = Observation("screen_counters")
    is_b = F.coalesce(F.col("market_cap").endswith("B"), F.lit(False))
    passed = ~F.col("bad_width") & (is_b if billion else ~is_b) & cap_usd("market_cap").isNotNull()
    data = parsed.where(~F.col("is_header")).observe(
        obs, F.count(F.lit(1)).alias("attempted"), F.count_if(passed).alias("processed")
    )
    return screen(listing_records(data), billion), obs
