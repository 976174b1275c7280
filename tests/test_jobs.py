import glob
import os

from cinder import jobs


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def _lines(folder, pattern="part-*"):
    out = []
    for f in sorted(glob.glob(os.path.join(folder, pattern))):
        with open(f) as fh:
            out += fh.read().splitlines()
    return out


def test_wordcount_jobs(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in.txt")
    _write(src, "the cat, the hat\nThe end.\n")
    out = jobs.run(["wordcount", src, os.path.join(tmp_dir, "wc")], spark)
    assert out.rsplit("_", 1)[-1].isdigit()
    assert _lines(out) == ["(The,1)", "(cat,1)", "(end,1)", "(hat,1)", "(the,2)"]
    sh = jobs.run(["wordcount", src, os.path.join(tmp_dir, "wc17"), "--shards", "17", "--exact-output"], spark)
    assert sorted(_lines(sh)) == ["The\t1", "cat\t1", "end\t1", "hat\t1", "the\t2"]


def test_screen_financials_report_accesslog_jobs(spark, tmp_dir):
    lst = os.path.join(tmp_dir, "listing.csv")
    _write(lst, '"Symbol","Name","LastSale","MarketCap","IPOyear","Sector","industry","Summary Quote",\n'
                '"A","A, Inc.","1","$1.5M","n/a","Tech","i","u",\n"B","B, Inc.","1","$2B","n/a","Tech","i","u",\n')
    out = jobs.run(["screen", lst, os.path.join(tmp_dir, "scr"), "--exact-output"], spark)
    assert _lines(os.path.join(out, "totals")) == ["sector,company_count,total_cap,total_market_cap",
                                                   'Tech,1,1500000.00,"$1,500,000.00"']
    assert sorted(_lines(os.path.join(out, "counters")))[-2:] == ["Tech,false,2,1", "sector,is_total,attempted,processed"]
    fin = os.path.join(tmp_dir, "fin.csv")
    _write(fin, "Symbol,Name,Sector,Price,Dividend Yield,Price/Earnings,a,b,52 week low,52 week high,c,d,e,f,g\n"
                "AA,x,s,1,1.31,,,,1,2,,,,,\nAB,x,s,1,bad,1,,,1,2,,,,,\nAC,x,s,1,2,3,,,4,5,,,,,\n")
    fo = jobs.run(["financials", fin, os.path.join(tmp_dir, "fo"), "--exact-output"], spark)
    assert _lines(fo) == ["(AA,1.31,-Infinity)", "(AC,2,3)"]
    ex = os.path.join(tmp_dir, "ex.csv")
    _write(ex, '"AC","x","1","$1M","n/a","Tech","i","u",\n"AA","y","1","$1M","n/a","Tech","i","u",\n')
    ro = jobs.run(["report", fin, ex, os.path.join(tmp_dir, "rep"), "--exact-output", "--k", "2"], spark)
    rep = spark.read.option("header", True).csv(ro)
    assert rep.where("section = 'common_total'").first().value == "2"
    log = os.path.join(tmp_dir, "access_log")
    _write(log, '10.0.0.1 - - [2024-01-01] "GET /a HTTP/1.0" 200 5\nbad line\n')
    lo = jobs.run(["accesslog", log, os.path.join(tmp_dir, "al"), "--exact-output"], spark)
    assert spark.read.parquet(lo).where("ip IS NOT NULL").count() == 1


def test_ratings_job(spark, tmp_dir):
    src = os.path.join(tmp_dir, "ratings.tsv")
    _write(src, "2031-02-03 04:05:06\t11\t21\t5\tfirst message\n2031-02-04 07:08:09\t12\t22\t2\tsecond message\n")
    spark.sql("DROP TABLE IF EXISTS ratings_job_t")
    assert jobs.run(["ratings", src, "ratings_job_t"], spark) == "2"
    assert jobs.run(["ratings", src, "ratings_job_t"], spark) == "2"  # reload replaces
    assert spark.table("ratings_job_t").where("rating = 5").count() == 1
    spark.sql("DROP TABLE IF EXISTS ratings_job_t")
