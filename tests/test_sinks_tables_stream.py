import glob
import os
import time

from pyspark.sql import types as T

from cinder import sinks, tables
from cinder.operators import retail
from cinder.operators.words import word_count
from cinder.sources.external import create_external_table, overwrite_load, read_external
from cinder.sources.text import first_line, read_lines
from cinder.streaming import word_count_stream
from conftest import SF_SMALL, lines_df


def _read_text(folder):
    out = []
    for f in sorted(glob.glob(os.path.join(folder, "part-*"))):
        with open(f) as fh:
            out.append(fh.read().splitlines())
    return out


def test_tuple_and_key_value_text(spark, tmp_dir):
    df = spark.createDataFrame([("and", 3), ("a", 1)], "word string, n long")
    p = os.path.join(tmp_dir, "t")
    sinks.write_tuples(df.coalesce(1), p)
    assert sorted(sum(_read_text(p), [])) == ["(a,1)", "(and,3)"]
    kv = os.path.join(tmp_dir, "kv")
    sinks.write_key_value(df.coalesce(1), kv, "word", "n")
    assert sorted(sum(_read_text(kv), [])) == ["a\t1", "and\t3"]


def test_sharded_sorted(spark, tmp_dir):
    wc = word_count(lines_df(spark, [f"w{i} w{i % 50}" for i in range(400)]))
    p = os.path.join(tmp_dir, "s")
    sinks.write_sharded(wc, p, "word", 17, "n")
    shards = _read_text(p)
    assert len(glob.glob(os.path.join(p, "part-*"))) <= 17
    for lines in shards:
        keys = [x.split("\t")[0] for x in lines]
        assert keys == sorted(keys)
    assert sum(len(x) for x in shards) == wc.count()


def test_stamped_path_and_errorifexists(spark, tmp_dir):
    p = sinks.stamped_path(os.path.join(tmp_dir, "out"), 1478322014948)
    assert p.endswith("out_1478322014948")
    assert sinks.stamped_path("x").split("_")[-1].isdigit()
    df = spark.range(3)
    sinks.write_report(df, p)
    try:
        sinks.write_report(df, p)
        raise AssertionError("second write should fail")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "path" in str(e).lower()


def test_table_lifecycle(spark, tmp_dir):
    schema = T.StructType([T.StructField("posted", T.TimestampNTZType()), T.StructField("cust_id", T.IntegerType()),
                           T.StructField("prod_id", T.IntegerType()), T.StructField("rating", T.ByteType()),
                           T.StructField("message", T.StringType())])
    tables.drop_table(spark, "ratings_t")
    tables.create_table(spark, "ratings_t", schema, comment="Ratings table")
    tables.create_table(spark, "ratings_t", schema)  # IF NOT EXISTS: no error
    desc = {r.col_name: r.data_type for r in tables.describe(spark, "ratings_t").collect()}
    assert desc["rating"] == "tinyint" and desc["posted"] == "timestamp_ntz"
    data = spark.createDataFrame([(None, 1, 2, 3, "m")], schema)
    overwrite_load(data, "ratings_t")
    overwrite_load(data, "ratings_t")  # replaces, does not append
    assert spark.table("ratings_t").count() == 1
    tables.rename_column_as_view(spark, "ratings_t", "message", "text", "ratings_v")
    assert "text" in spark.table("ratings_v").columns
    tables.drop_table(spark, "rewards_t")
    tables.rename_table(spark, "ratings_t", "rewards_t")
    assert spark.table("rewards_t").first().cust_id == 1
    tables.drop_table(spark, "rewards_t")
    tables.drop_table(spark, "rewards_t")  # safe to repeat


def test_external_table(spark, tmp_dir):
    src = f"{SF_SMALL}/nation.parquet"
    assert read_external(spark, src, "parquet").count() == 25
    tables.drop_table(spark, "nation_ext")
    create_external_table(spark, "nation_ext", src, "parquet")
    assert spark.table("nation_ext").count() == 25
    tables.drop_table(spark, "nation_ext")
    assert os.path.exists(src)  # external data is not deleted


def test_text_source_and_header(spark, tmp_dir):
    p = os.path.join(tmp_dir, "in.txt")
    with open(p, "w") as fh:
        fh.write("Symbol,Name\nA,x\nB,y\n")
    q = os.path.join(tmp_dir, "other.txt")
    with open(q, "w") as fh:
        fh.write("H2\nz\n")
    assert sorted(r.value for r in first_line(spark, p, q).collect()) == ["H2", "Symbol,Name"]
    assert read_lines(spark, p).count() == 3


def test_streaming_word_count(spark, tmp_dir):
    src = os.path.join(tmp_dir, "stream_in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("to be or not to be\n")
    q = (word_count_stream(spark, src).writeStream.outputMode("complete").format("memory")
         .queryName("wc_stream_test").start())
    try:
        q.processAllAvailable()
        with open(os.path.join(src, "b.txt"), "w") as fh:
            fh.write("be quick\n")
        time.sleep(1)
        q.processAllAvailable()
        got = dict(spark.sql("SELECT word, n FROM wc_stream_test").collect())
    finally:
        q.stop()
    assert got == {"to": 2, "be": 3, "or": 1, "not": 1, "quick": 1}


def test_sql_and_dataframe_routes_agree(spark):
    import datetime as dt
    for t in ["customer", "nation", "part", "lineitem", "orders"]:
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").createOrReplaceTempView(t)
    c, n, p = spark.table("customer"), spark.table("nation"), spark.table("part")
    li, o = spark.table("lineitem"), spark.table("orders")

    def same(a, b):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))

    same(retail.filter_like_prefix(c, "BUILDING", "Customer#0000001"),
         spark.sql(retail.SQL["filter_like_prefix"], args=dict(segment="BUILDING", prefix="Customer#0000001")))
    same(retail.lowest_price(p, 10), spark.sql(retail.SQL["lowest_price"], args=dict(k=10)))
    same(retail.count_distinct_concat(c), spark.sql(retail.SQL["count_distinct_concat"]))
    same(retail.distinct_addresses(c, 10), spark.sql(retail.SQL["distinct_addresses"], args=dict(k=10)))
    same(retail.customers_per_group(c, n), spark.sql(retail.SQL["customers_per_group"]))
    same(retail.top_products(li, p, 3), spark.sql(retail.SQL["top_products"], args=dict(k=3)))
    day = dt.date(1996, 1, 2)
    same(retail.orders_on_day(o, "F", day),
         spark.sql(retail.SQL["orders_on_day"], args=dict(status="F", y=1996, m=1, d=2)))
    same(retail.revenue_on_day(li, o, "F", dt.date(1997, 5, 1), dt.date(1997, 6, 1)),
         spark.sql(retail.SQL["revenue_on_day"], args=dict(status="F", start="1997-05-01", end="1997-06-01")))


def test_observed_counters(spark, tmp_dir):
    from cinder.operators import financials as fin
    from cinder.operators import screen as scr
    from cinder.plans import catalog as C

    out, obs = scr.screen_observed(C._listing(spark, SF_SMALL))
    out.write.mode("overwrite").parquet(os.path.join(tmp_dir, "screen"))
    agg = {(r.sector, r.is_total): (r.attempted, r.processed)
           for r in scr.screen_counters(C._listing(spark, SF_SMALL)).collect()}
    assert (obs.get["attempted"], obs.get["processed"]) == agg[(None, True)]
    cl, obs2 = fin.clean_observed(C._fin(spark, SF_SMALL))
    n = cl.count()
    c = fin.counts(C._fin(spark, SF_SMALL)).first()
    assert (obs2.get["valid"], obs2.get["invalid"]) == (c.valid, c.invalid) and n == c.valid


def test_report_written_by_executors(spark, tmp_dir):
    from cinder.plans import catalog as C

    rep = C.q_listing_report(spark, SF_SMALL)
    path = sinks.stamped_path(os.path.join(tmp_dir, "report"))
    sinks.write_report(rep, path)
    back = spark.read.parquet(path)
    assert back.count() == rep.count()
    assert back.where("section = 'top_dividend'").count() == 10


def test_revenue_is_one_plan_without_a_job(spark):
    import datetime as dt
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    got = []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            spark.sparkContext.setJobGroup(f"revenue{limit}", "building the plan")
            df = retail.revenue_on_day(li, o, "F", dt.date(1995, 1, 1), dt.date(1998, 1, 1))
            assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"revenue{limit}")
            got.append(df.first().total)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got[0] == got[1] and got[0] is not None


def test_text_lines_are_exact(spark, tmp_dir):
    df = spark.createDataFrame([("a\tb", 'q"q'), ("", "x"), (None, None), ("k", "")], "k string, v string")
    sinks.write_key_value(df.coalesce(1), f"{tmp_dir}/kv", "k", "v")
    data = open(glob.glob(f"{tmp_dir}/kv/part-*")[0], "rb").read()
    assert sorted(data.split(b"\n")[:-1]) == sorted([b'a\tb\tq"q', b"\tx", b"\t", b"k\t"])
    assert sorted(r.value for r in sinks.tuple_lines(df).collect()) == sorted(['(a\tb,q"q)', "(,x)", "(,)", "(k,)"])


def test_names_and_texts_are_quoted(spark, tmp_dir):
    schema = T.StructType([T.StructField("odd `name`", T.StringType()), T.StructField("b", T.IntegerType())])
    tables.drop_table(spark, "odd_t")
    tables.create_table(spark, "odd_t", schema, comment="it's \\ odd", options={"note": "o'k"})
    overwrite_load(spark.createDataFrame([("x", 1)], schema), "odd_t")
    assert spark.catalog.getTable("odd_t").description == "it's \\ odd"
    tables.rename_column(spark, "odd_t", "odd `name`", "plain")
    assert [r.col_name for r in tables.describe(spark, "odd_t").collect()] == ["plain", "b"]
    assert tuple(spark.table("odd_t").first()) == ("x", 1)
    tables.rename_column_as_view(spark, "odd_t", "plain", "again", "odd_v", lasting=True)
    assert [r.col_name for r in tables.describe(spark, "odd_v").collect()] == ["again", "b"]
    spark.sql("DROP VIEW odd_v")
    tables.drop_table(spark, "odd_t")


def test_external_table_with_schema_and_options(spark, tmp_dir):
    from cinder.sources import external
    path = f"{tmp_dir}/ext"
    spark.createDataFrame([("a;1",)], "v string").write.text(path)
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])
    tables.drop_table(spark, "ext_csv")
    create_external_table(spark, "ext_csv", path, "csv", schema=schema, options={"sep": ";"}, comment="outside")
    assert tuple(spark.table("ext_csv").first()) == ("a", 1)
    tables.drop_table(spark, "ext_csv")
    seen = []

    class Recorder:  # the Avro package is not here: only what would be asked is checked
        def sql(self, text):
            seen.append(text)
    create_external_table(Recorder(), "db.t", "/data/t", "avro", avro_schema_url="hdfs:///s/t.avsc")
    assert seen == ["CREATE TABLE IF NOT EXISTS `db`.`t` USING avro OPTIONS ('avroSchemaUrl' 'hdfs:///s/t.avsc') LOCATION '/data/t'"]
    assert external.read_external(spark, path, "csv", schema=schema, options={"sep": ";"}).first().n == 1
