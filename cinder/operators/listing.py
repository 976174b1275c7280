"""Two listings joined on symbol, top-10 rankings and the combined report
(JOIN-1/4, PRJ-5, TOP-1/2, NUM-1/4, FMT-2/3, SNK-5, MEM-1).

Only the columns each result needs are carried through the join (Catalyst
prunes the rest at the scan); ties in the top-k are broken by symbol.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinder.functions.formatting import currency, whole_percent
from cinder.functions.numbers import float_or_zero, growth
from cinder.operators.numbering import order_rows
from cinder.operators.topk import top_k
from cinder.sources.delimited import parse_delimited, token_count

# The exchange list's fields in file order (it ends each line with a comma).
EXCHANGE_FIELDS = ["symbol", "name", "last_sale", "market_cap", "ipo_year", "sector", "industry", "summary_quote", "extra"]
EXCHANGE_WIDTH = 9
EXCHANGE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in EXCHANGE_FIELDS])


def parse_exchange(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """All fields of each record; blank lines, header rows and records of another width dropped."""
    return _exchange(lines, line_col).where(~F.col("_malformed")).drop("_malformed", "line")


def exchange_rejects(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Records that do not have exactly the list's fields: the line and its field count."""
    return _exchange(lines, line_col).where("_malformed").select("line", token_count(F.col("line")).alias("n_tokens"))


def _exchange(lines: DataFrame, line_col: str) -> DataFrame:
    parsed = parse_delimited(lines.select(F.col(line_col).alias("value")), EXCHANGE_SCHEMA, keep_line=True)
    return parsed.where(F.trim(F.col("line")) != "").where(F.coalesce(F.lower(F.col("symbol")) != "symbol", F.lit(True)))


def join_both(fin: DataFrame, exch: DataFrame) -> DataFrame:
    """Inner equi-join on symbol; duplicate keys on both sides multiply (JOIN-1)."""
    return fin.join(exch, "symbol", "inner")


def join_both_lists(fin: DataFrame, exch: DataFrame) -> DataFrame:
    return join_both(fin.select("symbol"), exch.select("symbol"))


def join_both_details(fin: DataFrame, exch: DataFrame) -> DataFrame:
    """Every field of both sides for symbols in both (JOIN-4), prefixed fin_/ex_."""
    def fields(df):  # data fields only, not the parser's flags
        return [c for c in df.columns if c != "symbol" and not c.startswith("_")]

    f = fin.select("symbol", *[F.col(c).alias(f"fin_{c}") for c in fields(fin)])
    e = exch.select("symbol", *[F.col(c).alias(f"ex_{c}") for c in fields(exch)])
    return join_both(f, e)


def _top(df: DataFrame, value: str, k: int) -> DataFrame:
    # ORDER BY v DESC, symbol LIMIT k -> TakeOrderedAndProject: k rows per task, then k overall
    return top_k(df, [F.desc(value), F.asc("symbol")], k)


def dividends(joined: DataFrame) -> DataFrame:
    """(symbol, dividend FLOAT) with unparsable/missing -> 0 (PRJ-5)."""
    return joined.select("symbol", float_or_zero(F.col("dividend")).alias("dividend"))


def growths(joined: DataFrame) -> DataFrame:
    """(symbol, growth FLOAT) = (high - low) / low, 0 when low is 0 or unparsable (NUM-4)."""
    return joined.select("symbol", growth(F.col("low_52w"), F.col("high_52w")).alias("growth"))


def top_dividend(joined: DataFrame, k: int = 10) -> DataFrame:
    return _top(dividends(joined), "dividend", k).select(
        "symbol", "dividend", currency(F.col("dividend").cast("double")).alias("dividend_text")
    )


def top_growth(joined: DataFrame, k: int = 10) -> DataFrame:
    return _top(growths(joined), "growth", k).select(
        "symbol", "growth", whole_percent(F.col("growth")).alias("growth_text")
    )


def report(fin: DataFrame, exch: DataFrame, k: int = 10) -> DataFrame:
    """SNK-5 as one DataFrame (section, rank, symbol, value):

    * ``common``: symbols in both lists, numbered 1..N in symbol order (NUM-1);
    * ``common_total``: N;
    * ``top_dividend`` / ``top_growth``: ranks 1..k with the formatted value.

    The join runs once: its rows (symbol, dividend, growth) are put in order and
    staged as a table. The numbers read it once, both rankings together once more,
    the total only the counts per partition (MEM-1 without a cache left behind; a
    re-run task reads the same rows).
    """
    joined = join_both(fin.select("symbol", "dividend", "low_52w", "high_52w"), exch.select("symbol"))
    values = joined.select(
        "symbol",
        float_or_zero(F.col("dividend")).alias("dividend"),
        growth(F.col("low_52w"), F.col("high_52w")).alias("growth"),
    )
    ordered = order_rows(values, ["symbol", "dividend", "growth"])
    none = F.lit(None).cast("string")
    common = ordered.numbered("rank").select(F.lit("common").alias("section"), "rank", "symbol", none.alias("value"))
    total = ordered.total().select(
        F.lit("common_total").alias("section"), F.lit(None).cast("bigint").alias("rank"),
        none.alias("symbol"), F.col("n").cast("string").alias("value"),
    )
    sections = F.inline(F.array(
        F.struct(F.lit("top_dividend").alias("section"), F.col("symbol"), F.col("dividend").alias("x")),
        F.struct(F.lit("top_growth").alias("section"), F.col("symbol"), F.col("growth").alias("x"))))
    # rank <= k is taken per task before the shuffle (partial WindowGroupLimit)
    best = Window.partitionBy("section").orderBy(F.desc("x"), F.asc("symbol"))
    tops = ordered.data().select(sections).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    text = F.when(F.col("section") == "top_dividend", currency(F.col("x").cast("double"))).otherwise(whole_percent(F.col("x")))
    return common.unionByName(total).unionByName(tops.select("section", F.col("rank").cast("bigint").alias("rank"), "symbol", text.alias("value")))
