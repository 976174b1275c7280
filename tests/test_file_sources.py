import datetime as dt
import os

from cinder.operators import financials as fin
from cinder.operators import screen as scr
from cinder.sources.delimited import RATINGS_SCHEMA
from cinder.sources.delimited import read_delimited, read_typed_tsv
from cinder.sinks import tuple_lines
from cinder.sources.text import read_lines


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_typed_tsv_file(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ratings.tsv")
    _write(p, "2031-02-03 04:05:06\t11\t21\t5\tfirst message\n2031-02-04 07:08:09\t12\t22\t300\tsecond\n"
              "2031-02-05 10:11:12\t13\t23\t2\t\n\\N\t14\t24\t1\t\\N\n")
    df = read_typed_tsv(spark, p, RATINGS_SCHEMA)
    by = {r.prod_id: tuple(r) for r in df.collect()}
    assert by[21] == (dt.datetime(2031, 2, 3, 4, 5, 6), 11, 21, 5, "first message")
    assert by[22][3:] == (None, "second")  # 300 overflows TINYINT
    assert by[23][4] == "" and by[24] == (None, 14, 24, 1, None)
    assert df.schema["rating"].dataType.simpleString() == "tinyint"


def test_multi_file_listing_with_headers(spark, tmp_dir):
    d = os.path.join(tmp_dir, "listing")
    os.makedirs(d)
    head = '"Symbol","Name","LastSale","MarketCap","IPOyear","Sector","industry","Summary Quote",\n'
    _write(os.path.join(d, "a.csv"), head + '"A","A, Inc.","1","$1M","n/a","Tech","i","u",\n')
    _write(os.path.join(d, "b.csv"), head + '"B","B, Inc.","1","$2M","n/a","Tech","i","u",\n"C","short"\n')
    parsed = scr.parse_listing(read_lines(spark, d))
    assert sorted(r.symbol for r in scr.listing_records(parsed).collect()) == ["A", "B"]
    assert [r.n_tokens for r in scr.listing_rejects(parsed).collect()] == [2]
    assert {r.sector: r.company_count for r in scr.screen(scr.listing_records(parsed)).collect()} == {"Tech": 2}


def test_financials_file(spark, tmp_dir):
    p = os.path.join(tmp_dir, "fin.csv")
    hdr = ("Symbol,Name,Sector,Price,Dividend Yield,Price/Earnings,Earnings/Share,Book Value,"
           "52 week low,52 week high,Market Cap,EBITDA,Price/Sales,Price/Book,SEC Filings\n")
    _write(p, hdr + "AA,Alcoa,Materials,1,1.31,,,,1,2,,,,,\nAAL,American,Ind,1,1.41,2.69,,,1,2,,,,,\n")
    f = fin.parse_financials(read_lines(spark, p))
    got = sorted(r.value for r in tuple_lines(fin.clean_text(f), ["symbol", "dividend", "pe"]).collect())
    assert got == ["(AA,1.31,-Infinity)", "(AAL,1.41,2.69)"]
    raw = read_delimited(spark, p, fin.FINANCIALS_SCHEMA)
    assert raw.count() == 3  # header included at this level; parse_financials drops it
