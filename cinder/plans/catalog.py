"""Named queries: each takes (spark, sf_dir) and returns a lazy DataFrame."""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinder.operators import financials as fin_ops
from cinder.operators import listing as lst
from cinder.operators import nested, retail, stored, words
from cinder.operators import screen as scr
from cinder.plans import fixtures as fx
from cinder import sinks, tables, versioned
from cinder.operators.staging import new_folder
from cinder.sources.delimited import RATINGS_SCHEMA, parse_hive_text, read_typed_tsv
from cinder.sources.external import create_external_table, overwrite_load, read_external
from cinder.sources.regex_log import parse_access_log, parse_referrer_log
from cinder.sources.tables import TABLE_SCHEMAS, read_table, table_path
from cinder.sources.text import first_line, read_lines

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return register


def _documents_as_lines(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("text")


@query("word_count")
def q_word_count(spark, sf_dir):
    return words.word_count(_documents_as_lines(spark, sf_dir), "text")


@query("word_count_sorted")
def q_word_count_sorted(spark, sf_dir):
    return words.word_count_sorted(_documents_as_lines(spark, sf_dir), "text")


# ---------------------------------------------------------------- retail worksheet


RETAIL_PARAMS = {
    "segment": "BUILDING",
    "name_prefix": "Customer#00000001",
    "status": "F",
    "day": _dt.date(2000, 8, 3),
    "month_start": _dt.date(1997, 5, 1),
    "month_end": _dt.date(1997, 6, 1),
}
LOYALTY_CUSTOMER = 13  # the customer of the point lookup


@query("filter_like_prefix")
def q_filter_like_prefix(spark, sf_dir):
    p = RETAIL_PARAMS
    return retail.filter_like_prefix(read_table(spark, sf_dir, "customer"), p["segment"], p["name_prefix"])


@query("lowest_price")
def q_lowest_price(spark, sf_dir):
    return retail.lowest_price(read_table(spark, sf_dir, "part"), 10)


@query("count_distinct_concat")
def q_count_distinct_concat(spark, sf_dir):
    return retail.count_distinct_concat(read_table(spark, sf_dir, "customer"))


@query("distinct_addresses")
def q_distinct_addresses(spark, sf_dir):
    return retail.distinct_addresses(read_table(spark, sf_dir, "customer"), 10)


@query("customers_per_group")
def q_customers_per_group(spark, sf_dir):
    return retail.customers_per_group(read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "nation"))


@query("top_products")
def q_top_products(spark, sf_dir):
    return retail.top_products(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part"), 3)


@query("orders_on_day")
def q_orders_on_day(spark, sf_dir):
    p = RETAIL_PARAMS
    return retail.orders_on_day(read_table(spark, sf_dir, "orders"), p["status"], p["day"])


@query("revenue_on_day")
def q_revenue_on_day(spark, sf_dir):
    p = RETAIL_PARAMS
    return retail.revenue_on_day(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders"),
                                 p["status"], p["month_start"], p["month_end"])


@query("revenue_formatted")
def q_revenue_formatted(spark, sf_dir):
    p = RETAIL_PARAMS
    return retail.revenue_formatted(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders"),
                                    p["status"], p["month_start"], p["month_end"])


@query("count_rows")
def q_count_rows(spark, sf_dir):
    return retail.count_rows(read_table(spark, sf_dir, "events"))


@query("external_table_scan")
def q_external_table_scan(spark, sf_dir):
    # the schema is declared outside the table, as an external table's is
    return read_external(spark, table_path(sf_dir, "orders"), "parquet", schema=TABLE_SCHEMAS["orders"])


# ---------------------------------------------------------------- listing screener (D1)


def _listing(spark, sf_dir):
    return scr.parse_listing(fx.listing_lines(spark, sf_dir))


@query("listing_parse")
def q_listing_parse(spark, sf_dir):
    return scr.listing_records(_listing(spark, sf_dir)).select("symbol", "name", "market_cap", "sector")


@query("listing_rejects")
def q_listing_rejects(spark, sf_dir):
    return scr.listing_rejects(_listing(spark, sf_dir))


@query("cap_normalize")
def q_cap_normalize(spark, sf_dir):
    return scr.cap_normalize(scr.listing_records(_listing(spark, sf_dir)))


@query("screen_million")
def q_screen_million(spark, sf_dir):
    return scr.screen(scr.listing_records(_listing(spark, sf_dir)), billion=False)


@query("screen_billion")
def q_screen_billion(spark, sf_dir):
    return scr.screen(scr.listing_records(_listing(spark, sf_dir)), billion=True)


@query("screen_known_sectors")
def q_screen_known_sectors(spark, sf_dir):
    return scr.screen(scr.listing_records(_listing(spark, sf_dir)), billion=False, known_sectors_only=True)


@query("screen_symbols")
def q_screen_symbols(spark, sf_dir):
    return scr.screen_symbols(scr.listing_records(_listing(spark, sf_dir)), billion=False, chunk_size=100)


@query("screen_symbol_rows")
def q_screen_symbol_rows(spark, sf_dir):
    return scr.screen_symbol_rows(scr.listing_records(_listing(spark, sf_dir)), billion=False)


@query("screen_formatted")
def q_screen_formatted(spark, sf_dir):
    return scr.screen_formatted(scr.listing_records(_listing(spark, sf_dir)), billion=False)


@query("screen_counters")
def q_screen_counters(spark, sf_dir):
    return scr.screen_counters(_listing(spark, sf_dir), billion=False)


# ---------------------------------------------------------------- financials (D2) and exchange list (D3)


def _fin(spark, sf_dir):
    return fin_ops.parse_financials(fx.financials_lines(spark, sf_dir))


def _exch(spark, sf_dir):
    return lst.parse_exchange(fx.exchange_lines(spark, sf_dir))


@query("financials_parse")
def q_financials_parse(spark, sf_dir):
    return _fin(spark, sf_dir).select("symbol", "dividend", "pe")


@query("financials_clean")
def q_financials_clean(spark, sf_dir):
    return fin_ops.clean(_fin(spark, sf_dir))


@query("financials_counts")
def q_financials_counts(spark, sf_dir):
    return fin_ops.counts(_fin(spark, sf_dir))


@query("tuple_render")
def q_tuple_render(spark, sf_dir):
    return sinks.tuple_lines(fin_ops.clean_text(_fin(spark, sf_dir)), ["symbol", "dividend", "pe"])


@query("join_both_lists")
def q_join_both_lists(spark, sf_dir):
    return lst.join_both_lists(_fin(spark, sf_dir), _exch(spark, sf_dir))


@query("join_both_details")
def q_join_both_details(spark, sf_dir):
    return lst.join_both_details(_fin(spark, sf_dir), _exch(spark, sf_dir))


@query("top10_dividend")
def q_top10_dividend(spark, sf_dir):
    return lst.top_dividend(lst.join_both(_fin(spark, sf_dir), _exch(spark, sf_dir).select("symbol")), 10)


@query("top10_growth")
def q_top10_growth(spark, sf_dir):
    return lst.top_growth(lst.join_both(_fin(spark, sf_dir), _exch(spark, sf_dir).select("symbol")), 10)


@query("listing_report")
def q_listing_report(spark, sf_dir):
    return lst.report(_fin(spark, sf_dir), _exch(spark, sf_dir), 10)


# ---------------------------------------------------------------- access log (D4), ratings (D5), loyalty (D6)

@query("log_parse")
def q_log_parse(spark, sf_dir):
    return parse_access_log(fx.access_log_lines(spark, sf_dir))


@query("log_parse_referrer")
def q_log_parse_referrer(spark, sf_dir):
    return parse_referrer_log(fx.access_log_lines(spark, sf_dir, empty_referrers=True))


@query("ratings_typed")
def q_ratings_typed(spark, sf_dir):
    return parse_hive_text(fx.ratings_lines(spark, sf_dir), RATINGS_SCHEMA)


def _as_files(lines, label):
    """Lines written as text files in the shared folder: the path."""
    folder = new_folder(lines.sparkSession, label)
    lines.write.text(folder)
    return folder


@query("ratings_file")
def q_ratings_file(spark, sf_dir):
    return read_typed_tsv(spark, _as_files(fx.ratings_lines(spark, sf_dir), "ratings"), RATINGS_SCHEMA)


@query("word_count_file")
def q_word_count_file(spark, sf_dir):
    return words.word_count(read_lines(spark, _as_files(_documents_as_lines(spark, sf_dir).where("text is not null"), "lines")))


@query("map_lookup")
def q_map_lookup(spark, sf_dir):
    return nested.map_lookup(fx.loyalty_rows(spark, sf_dir), "HOME")


@query("map_lookup_json")
def q_map_lookup_json(spark, sf_dir):
    return nested.json_map_lookup(read_table(spark, sf_dir, "events"), "event_id", "props", "k")


@query("array_element")
def q_array_element(spark, sf_dir):
    return nested.array_element(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 2)


@query("array_element_past_end")
def q_array_element_past_end(spark, sf_dir):
    return nested.array_element(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64)


@query("struct_field")
def q_struct_field(spark, sf_dir):
    return nested.struct_lookup(fx.loyalty_rows(spark, sf_dir), "total")


@query("column_rename")
def q_column_rename(spark, sf_dir):
    return nested.rename_column(fx.loyalty_rows(spark, sf_dir), "level", "status").select("cust_id", "status")


@query("loyalty_point_lookup")
def q_loyalty_point_lookup(spark, sf_dir):
    return nested.point_lookup(fx.loyalty_rows(spark, sf_dir), LOYALTY_CUSTOMER)


@query("orders_by_calendar_day")
def q_orders_by_calendar_day(spark, sf_dir):
    return retail.orders_by_calendar_day(read_table(spark, sf_dir, "orders"))


@query("cap_rejects")
def q_cap_rejects(spark, sf_dir):
    return scr.cap_rejects(scr.listing_records(scr.parse_listing(fx.listing_lines(spark, sf_dir))))


@query("exchange_rejects")
def q_exchange_rejects(spark, sf_dir):
    return lst.exchange_rejects(fx.exchange_lines(spark, sf_dir))


@query("key_value_render")
def q_key_value_render(spark, sf_dir):
    return sinks.key_value_lines(words.word_count(_documents_as_lines(spark, sf_dir), "text"), "word", "n")


# ---------------------------------------------------------------- stored layouts, loads and schema documents


def _fresh(label: str) -> str:
    """A table name that nothing has used."""
    return f"{label}_{uuid.uuid4().hex[:16]}"


@query("first_lines")
def q_first_lines(spark, sf_dir):
    """The first line of each of 16 files that customers are dealt to, in key order."""
    folder = new_folder(spark, "heads")
    lines = read_table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 16).alias("bucket"), "c_custkey", F.concat_ws(",", "c_custkey", "c_name").alias("value"))
    (lines.repartition(16, "bucket").sortWithinPartitions("bucket", "c_custkey").select("bucket", "value")
     .write.partitionBy("bucket").text(folder))
    return first_line(spark, folder).select(F.regexp_extract("file", "bucket=([0-9]+)", 1).cast("bigint").alias("bucket"), "value")


@query("word_count_shards")
def q_word_count_shards(spark, sf_dir):
    """Word counts in 17 sorted text files of a stamped folder, read back."""
    path = sinks.stamped_path(f"{new_folder(spark, 'shards')}/counts")
    sinks.write_sharded(words.word_count(_documents_as_lines(spark, sf_dir), "text"), path, "word", 17, "n")
    return read_lines(spark, path)


@query("loyalty_keyed_lookup")
def q_loyalty_keyed_lookup(spark, sf_dir):
    folder = new_folder(spark, "loyalty")
    stored.write_keyed(fx.loyalty_rows(spark, sf_dir), folder, "cust_id")
    return nested.point_lookup(stored.lookup(spark.read.parquet(folder), "cust_id", LOYALTY_CUSTOMER))


# The six external tables of the retail database by the table that stands in for each, and its key.
EXTERNAL_TABLES = {"categories": ("region", "r_regionkey"), "departments": ("nation", "n_nationkey"), "customers": ("customer", "c_custkey"),
                   "orders": ("orders", "o_orderkey"), "order_items": ("lineitem", "l_orderkey"), "products": ("part", "p_partkey")}
AVRO_OF = {"INT": "int", "BIGINT": "long", "DOUBLE": "double", "STRING": "string",
           "TIMESTAMP_NTZ": {"type": "long", "logicalType": "local-timestamp-micros"}}


def avro_document(name: str, ddl: str) -> str:
    """An Avro schema document of a table of nullable columns."""
    fields = [c.split() for c in ddl.split(", ")]
    return json.dumps({"type": "record", "name": name, "namespace": "retail",
                       "fields": [{"name": c, "type": ["null", AVRO_OF[t]], "default": None} for c, t in fields]})


@query("external_schema_scan")
def q_external_schema_scan(spark, sf_dir):
    """Six external tables whose columns stand in schema documents in the shared folder: rows, keys and their sum of each."""
    documents, out = new_folder(spark, "schemas"), None
    for name, (table, key) in EXTERNAL_TABLES.items():
        spark.createDataFrame([(avro_document(name, TABLE_SCHEMAS[table]),)], "value string").coalesce(1).write.text(f"{documents}/{name}.avsc")
        declared = _fresh(name)
        create_external_table(spark, declared, table_path(sf_dir, table), "parquet", avro_schema_url=f"{documents}/{name}.avsc")
        rows = spark.table(declared).agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.sum(key).alias("key_sum"))
        rows = rows.select(F.lit(name).alias("table_name"), F.lit(len(spark.table(declared).columns)).alias("n_columns"), "n_rows", "n_keys", "key_sum")
        out = rows if out is None else out.unionByName(rows)
    return out


def _bucketed_listings(spark, sf_dir, fin_columns=None, ex_columns=None):
    fin, ex = _fresh("financials"), _fresh("exchange")
    stored.write_bucketed_pair(_fin(spark, sf_dir), _exch(spark, sf_dir), "symbol", fin, ex, 8, new_folder(spark, "listings"))
    return stored.join_bucketed(spark, fin, ex, "symbol", fin_columns, ex_columns)


@query("join_bucketed_lists")
def q_join_bucketed_lists(spark, sf_dir):
    return _bucketed_listings(spark, sf_dir, [], [])


@query("join_bucketed_details")
def q_join_bucketed_details(spark, sf_dir):
    fields = lambda df, prefix: [F.col(c).alias(prefix + c) for c in df.columns if c != "symbol" and not c.startswith("_")]
    return _bucketed_listings(spark, sf_dir, fields(_fin(spark, sf_dir), "fin_"), fields(_exch(spark, sf_dir), "ex_"))


@query("orders_on_day_stored")
def q_orders_on_day_stored(spark, sf_dir):
    p, name = RETAIL_PARAMS, _fresh("orders_by_month")  # a folder a day would be some kilobytes at these sizes
    stored.store_by_time(read_table(spark, sf_dir, "orders"), name, "o_orderdate", "order_month", new_folder(spark, "orders"), "month")
    return stored.orders_on_day(spark.table(name), p["status"], p["day"])


@query("revenue_stored")
def q_revenue_stored(spark, sf_dir):
    p, folder, by = RETAIL_PARAMS, new_folder(spark, "months"), [_fresh("orders_by_month"), _fresh("lines_by_month")]
    orders = read_table(spark, sf_dir, "orders")
    stored.store_by_time(orders, by[0], "o_orderdate", "order_month", folder, "month")
    stored.store_by_time(stored.lines_with_order_time(read_table(spark, sf_dir, "lineitem"), orders), by[1], "o_orderdate", "order_month", folder, "month")
    return stored.revenue_between(spark.table(by[1]), spark.table(by[0]), p["status"], p["month_start"], p["month_end"])


ORDERS_TABLE = T.StructType([T.StructField("o_orderkey", T.LongType(), True, {"comment": "the order"}), T.StructField("o_custkey", T.LongType()),
                             T.StructField("price", T.DecimalType(18, 2)), T.StructField("o_orderstatus", T.StringType())])


def _reloaded_orders(spark, sf_dir):
    """The orders as a versioned table, reloaded from its own rows without every third one, a column renamed, the table renamed."""
    name = _fresh("orders_v")
    versioned.create_versioned(spark, name, ORDERS_TABLE, partitioned_by=("o_orderstatus",), comment="Orders", location=new_folder(spark, "orders"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderstatus")
    overwrite_load(orders, name)
    overwrite_load(spark.table(name).where("o_orderkey % 3 <> 0"), name)
    tables.rename_column(spark, name, "o_custkey", "cust_id")
    tables.rename_table(spark, name, f"{name}_new")
    return f"{name}_new"


@query("table_reload")
def q_table_reload(spark, sf_dir):
    return spark.table(_reloaded_orders(spark, sf_dir)).groupBy("o_orderstatus").agg(
        F.count("*").alias("n_orders"), F.count_distinct("cust_id").alias("n_customers"), F.sum("price").cast("decimal(38,2)").alias("total"))


@query("table_describe")
def q_table_describe(spark, sf_dir):
    """DESCRIBE of the reloaded and renamed table, with the values that each column holds."""
    name = _reloaded_orders(spark, sf_dir)
    columns = spark.table(name).columns
    held = spark.table(name).agg(*[F.count(c).alias(c) for c in columns])
    held = held.select(F.inline(F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).alias("n_values")) for c in columns])))
    return versioned.describe_columns(spark, name).join(held, "col_name")
