"""DuckDB SQL that computes each named query independently of the Spark code.

Derived-fixture queries are computed from the source columns, never from the
generated strings, so the Spark-side parsing is really tested.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["word_count"] = r"""
SELECT word, count(*)::BIGINT AS n
FROM (SELECT unnest(regexp_split_to_array(text, '\W+')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
"""

ORACLE["word_count_sorted"] = ORACLE["word_count"] + " ORDER BY word"

ORACLE["filter_like_prefix"] = """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_mktsegment = 'BUILDING' AND c_name LIKE 'Customer#00000001%'
"""

ORACLE["lowest_price"] = """
SELECT p_partkey, p_name, p_retailprice FROM part
WHERE p_retailprice = (SELECT min(p_retailprice) FROM part)
ORDER BY p_retailprice, p_partkey LIMIT 10
"""

ORACLE["count_distinct_concat"] = """
SELECT count(DISTINCT c_mktsegment || CAST(c_nationkey AS VARCHAR))::BIGINT AS n_distinct FROM customer
"""

ORACLE["distinct_addresses"] = """
SELECT DISTINCT c_mktsegment || CAST(c_nationkey AS VARCHAR) AS address FROM customer
ORDER BY address LIMIT 10
"""

ORACLE["customers_per_group"] = """
SELECT n_name, count(c_custkey)::BIGINT AS customer_count
FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name ORDER BY customer_count DESC, n_name
"""

ORACLE["top_products"] = """
SELECT p_partkey AS product_id, p_name, sum(CAST(l_quantity AS DECIMAL(18,2)))::DECIMAL(18,2) AS total_qty
FROM part JOIN lineitem ON p_partkey = l_partkey
GROUP BY p_partkey, p_name ORDER BY total_qty DESC, product_id LIMIT 3
"""

ORACLE["orders_on_day"] = """
SELECT count(o_orderkey)::BIGINT AS n_orders FROM orders
WHERE o_orderstatus = 'F' AND year(o_orderdate) = 2000 AND month(o_orderdate) = 8 AND day(o_orderdate) = 3
"""

_REVENUE = """
SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DECIMAL(38,2) AS total FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'
                     AND year(o_orderdate) = 1997 AND month(o_orderdate) = 5)
"""
ORACLE["revenue_on_day"] = _REVENUE
ORACLE["revenue_formatted"] = f"SELECT '$' || CAST(total AS VARCHAR) AS total FROM ({_REVENUE})"

ORACLE["count_rows"] = "SELECT count(*)::BIGINT AS n_rows FROM events"

ORACLE["external_table_scan"] = "SELECT * FROM orders"

# ---------------------------------------------------------------- D1 listing, from customer columns
_D1 = """
WITH d AS (
  SELECT c_custkey AS k, c_name AS symbol, c_name || ', Inc.' AS name,
         CASE WHEN c_custkey % 17 = 0 THEN 'n/a' ELSE c_mktsegment END AS sector,
         CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS x
  FROM customer),
r AS (
  SELECT *, k % 101 = 50 AS short_row,
         CASE WHEN k % 13 = 0 THEN 'n/a' WHEN k % 19 = 7 THEN '$1,200.5M' WHEN k % 23 = 3 THEN '$.5M' WHEN k % 23 = 4 THEN '$5.M'
              WHEN k % 29 = 9 THEN '$1.1234567891B' WHEN k % 29 = 10 THEN '$0.000000004B'
              WHEN k % 29 = 11 THEN '$2.00000000499M' WHEN k % 29 = 12 THEN '$3.005'
              WHEN k % 5 = 0 THEN '$' || CAST(x AS VARCHAR) || 'B'
              WHEN k % 7 = 0 THEN '$' || CAST(x AS VARCHAR) ELSE '$' || CAST(x AS VARCHAR) || 'M' END AS market_cap,
         CASE WHEN k % 13 = 0 OR k % 19 = 7 THEN NULL WHEN k % 23 IN (3, 4) THEN 'M'
              WHEN k % 29 IN (9, 10) THEN 'B' WHEN k % 29 = 11 THEN 'M' WHEN k % 29 = 12 THEN '' WHEN k % 5 = 0 THEN 'B' WHEN k % 7 = 0 THEN '' ELSE 'M' END AS cap_unit,
         CAST(CASE WHEN k % 13 = 0 THEN 0 WHEN k % 19 = 7 THEN NULL WHEN k % 23 = 3 THEN 500000 WHEN k % 23 = 4 THEN 5000000
              WHEN k % 29 = 9 THEN 1123456789.10 WHEN k % 29 = 10 THEN 4 WHEN k % 29 = 11 THEN 2000000.00 WHEN k % 29 = 12 THEN 3.01
              WHEN k % 5 = 0 THEN x * 1000000000 WHEN k % 7 = 0 THEN x
              ELSE x * 1000000 END AS DECIMAL(38,2)) AS cap_usd,
         k % 13 <> 0 AND k % 19 <> 7 AND k % 23 NOT IN (3, 4) AND (k % 29 IN (9, 10) OR k % 29 NOT IN (11, 12) AND k % 5 = 0) AS is_b
  FROM d),
v AS (SELECT * FROM r WHERE NOT short_row)
"""

ORACLE["listing_parse"] = _D1 + "SELECT symbol, name, market_cap, sector FROM v"

ORACLE["listing_rejects"] = _D1 + """
SELECT '"' || symbol || '","' || name || '","1.00"' AS line, 3 AS n_tokens FROM r WHERE short_row"""

ORACLE["cap_normalize"] = _D1 + "SELECT symbol, market_cap, cap_unit, cap_usd FROM v"

_SCREEN = _D1 + """
SELECT sector, count(*)::BIGINT AS company_count, sum(cap_usd)::DECIMAL(38,2) AS total_cap
FROM v WHERE cap_usd IS NOT NULL AND {cond} GROUP BY sector"""

ORACLE["screen_million"] = _SCREEN.format(cond="NOT is_b")
ORACLE["screen_billion"] = _SCREEN.format(cond="is_b")
ORACLE["screen_known_sectors"] = _SCREEN.format(cond="NOT is_b AND lower(sector) <> 'n/a'")

ORACLE["screen_symbols"] = _D1 + """
SELECT sector, part, string_agg(symbol, ', ' ORDER BY symbol) AS symbols, count(*)::BIGINT AS n_symbols
FROM (SELECT sector, symbol,
             CAST((row_number() OVER (PARTITION BY sector ORDER BY symbol) - 1) // 100 AS INTEGER) AS part
      FROM v WHERE NOT is_b AND cap_usd IS NOT NULL)
GROUP BY sector, part"""

ORACLE["screen_symbol_rows"] = _D1 + """
SELECT sector, row_number() OVER (PARTITION BY sector ORDER BY symbol)::BIGINT AS position, symbol
FROM v WHERE NOT is_b AND cap_usd IS NOT NULL"""

ORACLE["screen_formatted"] = _D1 + """
SELECT 'Sector: ' || sector AS sector_label, count(*)::BIGINT AS company_count,
       '$' || format('{:,.2f}', sum(cap_usd)::DECIMAL(38,2)) AS total_market_cap
FROM v WHERE NOT is_b AND cap_usd IS NOT NULL GROUP BY sector"""

ORACLE["screen_counters"] = _D1 + """
SELECT CASE WHEN short_row THEN NULL ELSE sector END AS sector, false AS is_total,
       count(*)::BIGINT AS attempted, count(*) FILTER (WHERE NOT short_row AND NOT is_b AND cap_usd IS NOT NULL)::BIGINT AS processed
FROM r GROUP BY 1
UNION ALL
SELECT NULL, true, count(*)::BIGINT, count(*) FILTER (WHERE NOT short_row AND NOT is_b AND cap_usd IS NOT NULL)::BIGINT FROM r"""

# ---------------------------------------------------------------- D2 financials / D3 exchange, from part columns
_D2 = """
WITH p AS (
  SELECT p_partkey AS k, 'P' || CAST(p_partkey AS VARCHAR) AS symbol, p_name, p_brand, p_size,
         CAST(p_retailprice AS DECIMAL(12,2)) AS price
  FROM part),
f AS (
  SELECT k, symbol, p_name AS name, p_brand AS sector, '1.0' AS price,
         CASE WHEN k % 7 = 0 THEN NULL WHEN k % 11 = 0 THEN 'bad' WHEN k % 31 = 5 THEN 'nan' WHEN k % 31 = 6 THEN 'inf'
              ELSE CAST(CAST(p_size * 0.125 AS DECIMAL(10,3)) AS VARCHAR) END AS dividend,
         CASE WHEN k % 5 = 0 THEN NULL WHEN k % 23 = 0 THEN 'n/a' ELSE CAST(price AS VARCHAR) END AS pe,
         NULL::VARCHAR AS eps, NULL::VARCHAR AS book_value,
         CASE WHEN k % 19 = 0 THEN '0' WHEN k % 29 = 0 THEN NULL ELSE CAST(price AS VARCHAR) END AS low_52w,
         CAST(CAST(price + k % 97 AS DECIMAL(12,2)) AS VARCHAR) AS high_52w,
         NULL::VARCHAR AS market_cap, NULL::VARCHAR AS ebitda, NULL::VARCHAR AS price_sales,
         NULL::VARCHAR AS price_book, NULL::VARCHAR AS sec_filings
  FROM p),
fd AS (
  SELECT *, coalesce(dividend, '0.0') AS div_text, coalesce(pe, '-Infinity') AS pe_text,
         coalesce(dividend, '') NOT IN ('bad', 'nan', 'inf') AND coalesce(pe, '') <> 'n/a' AS ok
  FROM f),
e AS (
  SELECT CASE WHEN p_partkey % 3 = 0 THEN 'X' ELSE 'P' END || CAST(p_partkey AS VARCHAR) AS symbol,
         p_name || ', Inc.' AS name, '1.00' AS last_sale, '$' || CAST(p_size AS VARCHAR) || 'M' AS cap,
         CASE WHEN p_partkey % 4 = 0 THEN 'n/a' ELSE '1999' END AS ipo, p_brand AS ex_sec,
         CASE WHEN p_partkey % 6 <> 0 THEN p_type END AS ind, 'http://list/' || CAST(p_partkey AS VARCHAR) AS quote
  FROM part WHERE p_partkey % 41 <> 7),
j AS (
  SELECT f.*, e.name AS ex_name, e.last_sale AS ex_last_sale, cap, ipo, ex_sec, ind, quote,
         CASE WHEN f.dividend IN ('nan', 'inf') THEN 0::FLOAT ELSE coalesce(TRY_CAST(f.dividend AS FLOAT), 0::FLOAT) END AS div_f,
         TRY_CAST(f.low_52w AS FLOAT) AS lo, TRY_CAST(f.high_52w AS FLOAT) AS hi
  FROM f JOIN e ON f.symbol = e.symbol),
g AS (
  SELECT *, CASE WHEN lo IS NULL OR hi IS NULL THEN 0::FLOAT WHEN lo = 0 THEN 0::FLOAT
                 ELSE CAST((hi - lo) / lo AS FLOAT) END AS growth
  FROM j),
td AS (
  SELECT symbol, div_f AS dividend, '$' || format('{:,.2f}', round_even(CAST(div_f AS DOUBLE), 2)) AS dividend_text  -- half to even
  FROM g ORDER BY div_f DESC, symbol LIMIT 10),
tg AS (
  SELECT symbol, growth, format('{:,.0f}', CAST(growth AS DOUBLE) * 100) || '%' AS growth_text
  FROM g ORDER BY growth DESC, symbol LIMIT 10)
"""

ORACLE["financials_parse"] = _D2 + "SELECT symbol, dividend, pe FROM f"

ORACLE["financials_clean"] = _D2 + """
SELECT symbol, CAST(div_text AS FLOAT) AS dividend, CAST(pe_text AS FLOAT) AS pe FROM fd WHERE ok ORDER BY symbol"""

ORACLE["financials_counts"] = _D2 + """
SELECT count(*) FILTER (WHERE ok)::BIGINT AS valid, count(*) FILTER (WHERE NOT ok)::BIGINT AS invalid,
       count(*) FILTER (WHERE dividend IS NULL)::BIGINT AS no_dividend,
       count(*) FILTER (WHERE pe IS NULL)::BIGINT AS no_pe
FROM fd"""

ORACLE["tuple_render"] = _D2 + "SELECT '(' || symbol || ',' || div_text || ',' || pe_text || ')' AS value FROM fd WHERE ok"

ORACLE["join_both_lists"] = _D2 + "SELECT symbol FROM j"

ORACLE["join_both_details"] = _D2 + """
SELECT symbol, name AS fin_name, sector AS fin_sector, price AS fin_price, dividend AS fin_dividend,
       pe AS fin_pe, eps AS fin_eps, book_value AS fin_book_value, low_52w AS fin_low_52w,
       high_52w AS fin_high_52w, market_cap AS fin_market_cap, ebitda AS fin_ebitda,
       price_sales AS fin_price_sales, price_book AS fin_price_book, sec_filings AS fin_sec_filings,
       ex_name, ex_last_sale, cap AS ex_market_cap, ipo AS ex_ipo_year, ex_sec AS ex_sector, ind AS ex_industry,
       quote AS ex_summary_quote, NULL::VARCHAR AS ex_extra
FROM j"""

ORACLE["top10_dividend"] = _D2 + "SELECT * FROM td"

ORACLE["top10_growth"] = _D2 + "SELECT * FROM tg"

ORACLE["listing_report"] = _D2 + """
SELECT 'common' AS section, row_number() OVER (ORDER BY symbol)::BIGINT AS rank, symbol, NULL::VARCHAR AS value
FROM j
UNION ALL SELECT 'common_total', NULL, NULL, CAST(count(*) AS VARCHAR) FROM j
UNION ALL SELECT 'top_dividend', row_number() OVER (ORDER BY dividend DESC, symbol), symbol, dividend_text FROM td
UNION ALL SELECT 'top_growth', row_number() OVER (ORDER BY growth DESC, symbol), symbol, growth_text FROM tg"""

# ---------------------------------------------------------------- D4 access log, D5 ratings (events); D6 loyalty (orders)
ORACLE["log_parse"] = """
WITH x AS (SELECT *, event_id % 10 = 0 OR event_id % 15 = 1 OR event_id % 21 = 2 AS bad FROM events)
SELECT CASE WHEN bad THEN NULL ELSE '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.1' END AS ip,
       CASE WHEN bad THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS time_local,
       CASE WHEN bad THEN NULL ELSE 'GET' END AS method,
       CASE WHEN bad THEN NULL ELSE '/' || event_type END AS uri,
       CASE WHEN bad THEN NULL ELSE 'HTTP/1.0' END AS protocol,
       CASE WHEN bad THEN NULL ELSE '200' END AS status,
       CASE WHEN bad THEN NULL ELSE CAST(event_id % 5000 AS VARCHAR) END AS bytes_sent
FROM x"""

ORACLE["log_parse_referrer"] = """
WITH x AS (SELECT *, event_id % 10 <> 0 AND event_id % 21 <> 2 AS ok FROM events)
SELECT CASE WHEN ok THEN '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.1' END AS ip, CASE WHEN ok THEN strftime(ts, '%Y-%m-%d') END AS time_local,
       CASE WHEN ok THEN 'GET' END AS method, CASE WHEN ok THEN '/' || event_type END AS uri, CASE WHEN ok THEN 'HTTP/1.0' END AS protocol,
       CASE WHEN ok THEN '200' END AS status, CASE WHEN ok THEN CAST(event_id % 5000 AS VARCHAR) END AS bytes_sent,
       CASE WHEN ok AND event_id % 15 = 1 THEN 'ref' WHEN ok AND event_id % 15 = 4 THEN '' END AS referrer
FROM x"""

ORACLE["ratings_typed"] = """
SELECT date_trunc('second', ts) AS posted, CAST(user_id AS INTEGER) AS cust_id,
       CAST(event_id % 500 AS INTEGER) AS prod_id,
       CAST(CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_id % 6 END AS TINYINT) AS rating,
       CASE WHEN event_id % 40 = 1 THEN '' WHEN event_id % 40 = 2 THEN NULL ELSE event_type END AS message
FROM events"""

_D6 = """
WITH c AS (
  SELECT o_custkey AS k, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DECIMAL(38,2) AS total
  FROM orders GROUP BY o_custkey)
"""

ORACLE["map_lookup"] = _D6 + """
SELECT k AS cust_id,
       CASE WHEN k % 4 = 0 THEN NULL ELSE '555-' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') END AS home_phone
FROM c"""

ORACLE["map_lookup_json"] = "SELECT event_id, json_extract_string(props, '$.k') AS value FROM events"

ORACLE["array_element"] = "SELECT vec_id, embedding[3] AS element FROM embeddings"

ORACLE["array_element_past_end"] = "SELECT vec_id, embedding[65] AS element FROM embeddings"

ORACLE["struct_field"] = _D6 + "SELECT k AS cust_id, total AS order_total FROM c"

ORACLE["column_rename"] = _D6 + """
SELECT k AS cust_id, CASE WHEN n >= 12 THEN 'GOLD' ELSE 'SILVER' END AS status FROM c"""

ORACLE["loyalty_point_lookup"] = _D6 + """
SELECT k AS cust_id,
       CASE WHEN k % 4 = 0 THEN NULL ELSE '555-' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') END AS home_phone,
       total AS order_total, CASE WHEN n >= 12 THEN 'GOLD' ELSE 'SILVER' END AS level
FROM c WHERE k = 13"""

ORACLE["orders_by_calendar_day"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(month(o_orderdate) AS INTEGER) AS order_month,
       CAST(day(o_orderdate) AS INTEGER) AS order_day, count(o_orderkey)::BIGINT AS n_orders
FROM orders GROUP BY ALL"""

ORACLE["ratings_file"] = ORACLE["ratings_typed"]

ORACLE["word_count_file"] = ORACLE["word_count"]

ORACLE["cap_rejects"] = _D1 + "SELECT symbol, market_cap FROM v WHERE cap_usd IS NULL"

ORACLE["exchange_rejects"] = """
SELECT '"' || CASE WHEN p_partkey % 3 = 0 THEN 'X' ELSE 'P' END || CAST(p_partkey AS VARCHAR) || '","' || p_name || ', Inc.","1.00"' AS line,
       3 AS n_tokens
FROM part WHERE p_partkey % 41 = 7"""

ORACLE["key_value_render"] = f"SELECT word || chr(9) || CAST(n AS VARCHAR) AS value FROM ({ORACLE['word_count']})"

# ---------------------------------------------------------------- stored layouts, loads and schema documents
ORACLE["first_lines"] = """
SELECT c_custkey % 16 AS bucket, CAST(c_custkey AS VARCHAR) || ',' || c_name AS value
FROM customer QUALIFY row_number() OVER (PARTITION BY c_custkey % 16 ORDER BY c_custkey) = 1"""

ORACLE["word_count_shards"] = ORACLE["key_value_render"]

ORACLE["loyalty_keyed_lookup"] = ORACLE["loyalty_point_lookup"]

ORACLE["external_schema_scan"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, {n} AS n_columns, count(*)::BIGINT AS n_rows, count(DISTINCT {key})::BIGINT AS n_keys, sum({key})::BIGINT AS key_sum FROM {table}"
    for name, n, table, key in [("categories", 2, "region", "r_regionkey"), ("departments", 3, "nation", "n_nationkey"), ("customers", 5, "customer", "c_custkey"),
                                ("orders", 6, "orders", "o_orderkey"), ("order_items", 11, "lineitem", "l_orderkey"), ("products", 6, "part", "p_partkey")])

ORACLE["join_bucketed_lists"] = ORACLE["join_both_lists"]
ORACLE["join_bucketed_details"] = ORACLE["join_both_details"]
ORACLE["orders_on_day_stored"] = ORACLE["orders_on_day"]
ORACLE["revenue_stored"] = ORACLE["revenue_on_day"]

ORACLE["table_reload"] = """
SELECT o_orderstatus, count(*)::BIGINT AS n_orders, count(DISTINCT o_custkey)::BIGINT AS n_customers,
       sum(CAST(o_totalprice AS DECIMAL(18,2)))::DECIMAL(38,2) AS total
FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY o_orderstatus"""

ORACLE["table_describe"] = """
WITH o AS (SELECT count(o_orderkey) AS a, count(o_custkey) AS b, count(o_totalprice) AS c, count(o_orderstatus) AS d FROM orders WHERE o_orderkey % 3 <> 0)
SELECT 0 AS position, 'o_orderkey' AS col_name, 'bigint' AS data_type, 'the order' AS comment, false AS is_partition, a AS n_values FROM o
UNION ALL SELECT 1, 'cust_id', 'bigint', NULL, false, b FROM o
UNION ALL SELECT 2, 'price', 'decimal(18,2)', NULL, false, c FROM o
UNION ALL SELECT 3, 'o_orderstatus', 'string', NULL, true, d FROM o"""
