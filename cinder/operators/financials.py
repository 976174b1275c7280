"""Financials cleaning (SRC-3, PRJ-1/5/6, FLT-1/2, NUM-2/5, STR-6, AGG-12, SRT-2, SNK-1 text).

Input: 15-field CSV lines; ordinals 0 symbol, 4 dividend yield, 5 P/E,
8 52-week low, 9 52-week high. Blank dividend -> "0.0"; blank P/E -> "-Infinity";
a record whose dividend or P/E (after defaults) is not a float is faulty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinder.functions.numbers import try_float
from cinder.sources.delimited import parse_delimited, token_count

# Field names in file order (15 fields) and the defaults for blanks.
FINANCIALS_FIELDS = ["symbol", "name", "sector", "price", "dividend", "pe", "eps", "book_value",
                     "low_52w", "high_52w", "market_cap", "ebitda", "price_sales", "price_book", "sec_filings"]
FINANCIALS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in FINANCIALS_FIELDS])
DIVIDEND_DEFAULT = "0.0"
PE_DEFAULT = "-Infinity"
MIN_FIELDS = 6  # a record must reach the P/E field (ordinal 5)


def parse_financials(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """All fields as strings (blank -> NULL) plus ``_short`` (the record ends
    before the P/E field). Blank lines are not records; header rows
    (symbol = 'Symbol', any case) are dropped. Over-long rows keep their first
    15 fields. The field count is computed only for rows the parser flagged."""
    parsed = parse_delimited(lines.select(F.col(line_col).alias("value")), FINANCIALS_SCHEMA, keep_line=True)
    keep = (F.trim(F.col("line")) != "") & F.coalesce(F.lower(F.col("symbol")) != "symbol", F.lit(True))
    short = F.when(F.col("_malformed"), token_count(F.col("line")) < MIN_FIELDS).otherwise(F.lit(False))
    return parsed.where(keep).select(*FINANCIALS_FIELDS, short.alias("_short"))


def with_defaults(fin: DataFrame) -> DataFrame:
    """(symbol, dividend, pe) as text with the blank defaults applied (PRJ-6)."""
    return fin.select(
        "symbol",
        F.coalesce(F.col("dividend"), F.lit(DIVIDEND_DEFAULT)).alias("dividend"),
        F.coalesce(F.col("pe"), F.lit(PE_DEFAULT)).alias("pe"),
        "_short",
    )


def _valid(d: DataFrame) -> F.Column:
    """The record holds the fields, and dividend and P/E (blank defaults
    applied) both parse as floats."""
    div = F.coalesce(F.col("dividend"), F.lit(DIVIDEND_DEFAULT))
    pe = F.coalesce(F.col("pe"), F.lit(PE_DEFAULT))
    return ~F.col("_short") & try_float(div).isNotNull() & try_float(pe).isNotNull()


def clean(fin: DataFrame) -> DataFrame:
    """Valid records as (symbol, dividend FLOAT, pe FLOAT), ordered by symbol (FLT-1, SRT-2)."""
    d = with_defaults(fin)
    return d.where(_valid(d)).select(
        "symbol", try_float(F.col("dividend")).alias("dividend"), try_float(F.col("pe")).alias("pe")
    ).orderBy("symbol")


def clean_text(fin: DataFrame) -> DataFrame:
    """Valid records keeping the original number text (what the tuple output prints)."""
    d = with_defaults(fin)
    return d.where(_valid(d)).drop("_short")


def counts(fin: DataFrame) -> DataFrame:
    """Valid / invalid / no-dividend / no-P/E record counts in one pass (AGG-12)."""
    d = with_defaults(fin)
    ok = _valid(d)
    return fin.select(
        ok.alias("_ok"),
        (F.col("dividend").isNull() & ~F.col("_short")).alias("_nodiv"),
        (F.col("pe").isNull() & ~F.col("_short")).alias("_nope"),
    ).agg(
        F.count_if(F.col("_ok")).alias("valid"),
        F.count_if(~F.col("_ok")).alias("invalid"),
        F.count_if(F.col("_nodiv")).alias("no_dividend"),
        F.count_if(F.col("_nope")).alias("no_pe"),
    )


def clean_observed(fin: DataFrame):
    """``clean`` plus valid / invalid counts collected while it runs (the
    accumulator form of AGG-12). Returns ``(clean_df, observation)``."""
    from pyspark.sql import Observation

    obs = Observation("financials_counts")
    d = with_defaults(fin)
    ok = _valid(d)
    observed = d.observe(obs, F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"))
    return observed.where(_valid(observed)).select(
        "symbol", try_float(F.col("dividend")).alias("dividend"), try_float(F.col("pe")).alias("pe")
    ).orderBy("symbol"), obs
