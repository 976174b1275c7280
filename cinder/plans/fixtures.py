"""Dirty-text fixtures derived from the Parquet tables by Spark (FIXTURES.md D1-D6).

Each builder returns lines (``value`` STRING) or rows computed from a table, so
the work grows with the table. The DuckDB oracles compute the expected results
from the same source columns, never from these strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinder.sources.tables import read_table

# Header lines of the two listings (exchange company list with 9
# fields, S&P-style financials with 15 fields).
LISTING_HEADER = '"Symbol","Name","LastSale","MarketCap","IPOyear","Sector","industry","Summary Quote",'
FINANCIALS_HEADER = ("Symbol,Name,Sector,Price,Dividend Yield,Price/Earnings,Earnings/Share,Book Value,"
                     "52 week low,52 week high,Market Cap,EBITDA,Price/Sales,Price/Book,SEC Filings")
EXCHANGE_HEADER = LISTING_HEADER


def _with_header(spark: SparkSession, header: str, lines: DataFrame) -> DataFrame:
    # one row in one partition, built in the JVM
    head = spark.range(0, 1, 1, 1).select(F.lit(header).alias("value"))
    return head.unionByName(lines)


def listing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1: one quoted 9-field line per customer (3 fields when key % 101 = 50); some caps lack digits
    before or after the point, some have more decimals than cents, some are no number (key % 19 = 7)."""
    c = read_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k",
        "c_name",
        "CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS STRING) AS x",
        "CASE WHEN c_custkey % 17 = 0 THEN 'n/a' ELSE c_mktsegment END AS sector",
    )
    lines = c.selectExpr("""
        CASE WHEN k % 101 = 50 THEN concat('"', c_name, '","', c_name, ', Inc.","1.00"')
        ELSE concat('"', c_name, '","', c_name, ', Inc.","1.00","',
                    CASE WHEN k % 13 = 0 THEN 'n/a' WHEN k % 19 = 7 THEN '$1,200.5M'
                         WHEN k % 23 = 3 THEN '$.5M' WHEN k % 23 = 4 THEN '$5.M'
                         WHEN k % 29 = 9 THEN '$1.1234567891B' WHEN k % 29 = 10 THEN '$0.000000004B'
                         WHEN k % 29 = 11 THEN '$2.00000000499M' WHEN k % 29 = 12 THEN '$3.005'
                         WHEN k % 5 = 0 THEN concat('$', x, 'B')
                         WHEN k % 7 = 0 THEN concat('$', x) ELSE concat('$', x, 'M') END,
                    '","n/a","', sector, '","ind","url",')
        END AS value""")
    return _with_header(spark, LISTING_HEADER, lines)


def financials_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2: one 15-field financials line per part (dividend with three decimals, P/E, 52-week low/high);
    some dividends are texts that only look like floats ('nan', 'inf')."""
    p = read_table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS k", "p_name", "p_brand", "p_size",
        "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) AS price",
        "CAST(CAST(CAST(p_retailprice AS DECIMAL(12,2)) + p_partkey % 97 AS DECIMAL(12,2)) AS STRING) AS high",
    )
    lines = p.selectExpr("""
        concat_ws(',', concat('P', CAST(k AS STRING)), p_name, p_brand, '1.0',
                  CASE WHEN k % 7 = 0 THEN '' WHEN k % 11 = 0 THEN 'bad' WHEN k % 31 = 5 THEN 'nan' WHEN k % 31 = 6 THEN 'inf'
                       ELSE CAST(CAST(p_size * 0.125 AS DECIMAL(10,3)) AS STRING) END,
                  CASE WHEN k % 5 = 0 THEN '' WHEN k % 23 = 0 THEN 'n/a' ELSE price END,
                  '', '',
                  CASE WHEN k % 19 = 0 THEN '0' WHEN k % 29 = 0 THEN '' ELSE price END,
                  high, '', '', '', '', '') AS value""")
    return _with_header(spark, FINANCIALS_HEADER, lines)


def exchange_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: quoted 9-field exchange list, one line per part, some fields blank. Parts with
    key % 3 = 0 are listed under an exchange-only symbol ('X<key>'), so they are on this
    list but not in the financials; lines with key % 41 = 7 have 3 fields only."""
    lines = read_table(spark, sf_dir, "part").selectExpr("""
        concat('"', CASE WHEN p_partkey % 3 = 0 THEN 'X' ELSE 'P' END, CAST(p_partkey AS STRING),
               '","', p_name, ', Inc.","1.00"',
               CASE WHEN p_partkey % 41 = 7 THEN ''
                    ELSE concat(',"$', CAST(p_size AS STRING), 'M","', CASE WHEN p_partkey % 4 = 0 THEN 'n/a' ELSE '1999' END,
                                '","', p_brand, '",', CASE WHEN p_partkey % 6 = 0 THEN '' ELSE concat('"', p_type, '"') END,
                                ',"http://list/', CAST(p_partkey AS STRING), '",') END) AS value""")
    return _with_header(spark, EXCHANGE_HEADER, lines)


def access_log_lines(spark: SparkSession, sf_dir: str, empty_referrers: bool = False) -> DataFrame:
    """D4: one access-log line per event; bytes '-' when event_id % 10 = 0, a
    trailing referrer when event_id % 15 = 1, a trailing carriage return when
    event_id % 21 = 2 (none of these matches the whole pattern). With ``empty_referrers``
    an empty one when event_id % 15 = 4."""
    empty = """WHEN event_id % 15 = 4 THEN ' ""'""" if empty_referrers else ""
    return read_table(spark, sf_dir, "events").selectExpr(f"""
        concat('10.0.', CAST(user_id % 256 AS STRING), '.1 - - [', date_format(ts, 'yyyy-MM-dd'),
               '] "GET /', event_type, ' HTTP/1.0" 200 ',
               CASE WHEN event_id % 10 = 0 THEN '-' ELSE CAST(event_id % 5000 AS STRING) END,
               CASE WHEN event_id % 15 = 1 THEN ' "ref"' {empty} ELSE '' END,
               CASE WHEN event_id % 21 = 2 THEN chr(13) ELSE '' END) AS value""")


def ratings_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5: tab-separated ratings (posted, cust_id, prod_id, rating, message);
    rating 300 (out of TINYINT range) when event_id % 50 = 0, a blank message when
    event_id % 40 = 1, the null mark \\N when event_id % 40 = 2."""
    return read_table(spark, sf_dir, "events").selectExpr("""
        concat_ws('\t', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), CAST(user_id AS STRING),
                  CAST(event_id % 500 AS STRING),
                  CAST(CASE WHEN event_id % 50 = 0 THEN 300 ELSE event_id % 6 END AS STRING),
                  CASE WHEN event_id % 40 = 1 THEN '' WHEN event_id % 40 = 2 THEN '\\\\N' ELSE event_type END) AS value""")


def loyalty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6: one nested row per customer with orders: cust_id, email, fname, lname,
    order_value STRUCT<min,max,avg,total> of the order prices, phone MAP, level.

    There is no array of a customer's order ids: a hot customer's would make a row
    without bound. Array lookups run on a stored array (``embeddings.embedding``).
    """
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_custkey")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    agg = o.groupBy("o_custkey").agg(
        F.struct(
            F.min(price).alias("min"), F.max(price).alias("max"),
            F.avg(price).cast("decimal(18,2)").alias("avg"), F.sum(price).cast("decimal(38,2)").alias("total"),
        ).alias("order_value"),
        F.count(F.lit(1)).alias("_n"),
    )
    phone_no = F.concat(F.lit("555-"), F.lpad((k % 10000).cast("string"), 4, "0"))
    return agg.select(
        k.alias("cust_id"),  # as stored: a filter on it reaches the scan of orders
        F.concat(F.lit("cust"), k.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("F"), k.cast("string")).alias("fname"),
        F.concat(F.lit("L"), k.cast("string")).alias("lname"),
        "order_value",
        F.when(k % 4 == 0, F.create_map(F.lit("WORK"), phone_no))
        .otherwise(F.create_map(F.lit("HOME"), phone_no)).alias("phone"),
        F.when(F.col("_n") >= 12, F.lit("GOLD")).otherwise(F.lit("SILVER")).alias("level"),
    )
