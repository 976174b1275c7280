import math

from pyspark.sql import functions as F

from cinder.functions.formatting import dollars_plain
from cinder.functions.numbers import try_float
from cinder.operators import financials as fin
from cinder.operators import listing as lst
from cinder.sinks import tuple_lines
from conftest import lines_df, rows

HDR = ("Symbol,Name,Sector,Price,Dividend Yield,Price/Earnings,Earnings/Share,Book Value,"
       "52 week low,52 week high,Market Cap,EBITDA,Price/Sales,Price/Book,SEC Filings")


def line(sym, div, pe, low="10", high="20"):
    return f"{sym},Name,Sec,1.0,{div},{pe},,,{low},{high},,,,,"


def exchange(sym, cap="$1M", industry="i"):
    return f'"{sym}","n","1","{cap}","n/a","Tech","{industry}","u",'


def test_exchange_keeps_every_field_and_rejects_other_widths(spark):
    lines = [exchange("Symbol"), exchange("A", industry=""), '"B","n","1"', exchange("C") + '"more"', "", '"D, x","n","1","$2M",,,,"u",']
    got = {r.symbol: tuple(r) for r in lst.parse_exchange(lines_df(spark, lines, 2)).collect()}
    assert got == {"A": ("A", "n", "1", "$1M", "n/a", "Tech", None, "u", None), "D, x": ("D, x", "n", "1", "$2M", None, None, None, "u", None),
                   "C": ("C", "n", "1", "$1M", "n/a", "Tech", "i", "u", "more")}
    assert rows(lst.exchange_rejects(lines_df(spark, lines))) == [('"B","n","1"', 3)]


def test_float_text_is_the_jvms(spark):
    ok = ["1", "+1.5", "-.5", "5.", "1e3", "1.5f", "2D", "NaN", "-Infinity", " 3 ", "0x1p3"]
    bad = ["nan", "inf", "Inf", "infinity", "1,000", "", ".", "1e", "e3", "0x1", "1 2", "n/a"]
    df = lines_df(spark, ok + bad).select("value", try_float(F.col("value")).alias("x"))
    assert {r.value for r in df.where("x is not null").collect()} == set(ok)


def test_dividend_text_rounds_half_to_even_and_names_specials(spark):
    lines = [line("A", "0.125", "1"), line("B", "0.375", "1"), line("C", "NaN", "1"), line("D", "Infinity", "1"), line("E", "-1234.5", "1")]
    f, e = fin.parse_financials(lines_df(spark, lines)), lst.parse_exchange(lines_df(spark, [exchange(s) for s in "ABCDE"]))
    want = {"A": "$0.12", "B": "$0.38", "C": "$NaN", "D": "$Infinity", "E": "-$1,234.50"}
    assert {r.symbol: r.dividend_text for r in lst.top_dividend(lst.join_both(f, e.select("symbol"))).collect()} == want
    rep = lst.report(f, e).where("section = 'top_dividend'").collect()
    assert {r.symbol: r.value for r in rep} == want


def test_exact_dollars(spark):
    df = spark.sql("SELECT CAST('999999999999999.99' AS DECIMAL(38,2)) AS a, CAST('158952451234567.89' AS DECIMAL(38,2)) AS b, CAST(-5 AS DECIMAL(38,2)) AS c")
    assert tuple(df.select(*[dollars_plain(F.col(x)) for x in "abc"]).first()) == ("$999999999999999.99", "$158952451234567.89", "$-5.00")


def test_clean_defaults_and_rejects(spark):
    lines = [HDR, line("A", "", ""), line("B", "NaN", "-Infinity"), line("C", "1.5f", "1e3"),
             line("D", '"1,000"', "2"), line("E", " 2.5 ", "3"), line("F", "bad", "1"), line("G", "1", "n/a"),
             HDR.upper()]
    f = fin.parse_financials(lines_df(spark, lines, 3))
    got = {r.symbol: (r.dividend, r.pe) for r in fin.clean(f).collect()}
    assert got["A"] == (0.0, float("-inf"))  # blank dividend -> 0.0, blank P/E -> -Infinity
    assert math.isnan(got["B"][0]) and got["B"][1] == float("-inf")
    assert got["C"] == (1.5, 1000.0)  # Java float syntax is accepted
    assert got["E"] == (2.5, 3.0)  # padding blanks allowed
    assert set(got) == {"A", "B", "C", "E"}  # "1,000", "bad", "n/a" rejected; headers dropped
    c = fin.counts(f).first()
    assert (c.valid, c.invalid, c.no_dividend, c.no_pe) == (4, 3, 1, 1)
    text = sorted(r.value for r in tuple_lines(fin.clean_text(f), ["symbol", "dividend", "pe"]).collect())
    assert text[0] == "(A,0.0,-Infinity)"


def test_growth_and_dividend_rules(spark):
    lines = [line("L0", "1", "1", low="0", high="5"), line("LB", "1", "1", low="", high="5"),
             line("OK", "x", "1", low="4", high="5")]
    f = fin.parse_financials(lines_df(spark, lines))
    e = lines_df(spark, [exchange("L0"), exchange("LB"), exchange("OK")]).transform(lst.parse_exchange)
    j = lst.join_both(f, e.select("symbol"))
    g = {r.symbol: r.growth for r in lst.growths(j).collect()}
    assert g == {"L0": 0.0, "LB": 0.0, "OK": 0.25}
    d = {r.symbol: r.dividend for r in lst.dividends(j).collect()}
    assert d["OK"] == 0.0  # unparsable dividend counts as 0


def test_top10_ties_and_duplicates(spark):
    # 12 symbols all at 5.0: tie at rank 10 broken by symbol
    lines = [line(f"S{i:02d}", "5", "1") for i in range(12)] + [line("DUP", "9", "1"), line("DUP", "9", "1")]
    f = fin.parse_financials(lines_df(spark, lines, 4))
    ex = [exchange(f"S{i:02d}") for i in range(12)] + [exchange("DUP")] * 2
    e = lst.parse_exchange(lines_df(spark, ex, 3))
    assert lst.join_both_lists(f, e).count() == 12 + 4  # duplicate keys multiply
    top = [r.symbol for r in lst.top_dividend(lst.join_both(f, e.select("symbol")), 10).collect()]
    assert top == ["DUP"] * 4 + [f"S{i:02d}" for i in range(6)]
    rep = lst.report(f, e, 10)
    common = sorted((r.rank, r.symbol) for r in rep.where("section = 'common'").collect())
    assert [c[0] for c in common] == list(range(1, 17))
    assert rep.where("section = 'common_total'").first().value == "16"


def test_report_partition_independent(spark):
    lines = [line(f"S{i:03d}", str(i % 9), "1", low=str(i % 5), high=str(i % 7 + 5)) for i in range(200)]
    ex = [exchange(f"S{i:03d}") for i in range(0, 200, 2)]
    a = rows(lst.report(fin.parse_financials(lines_df(spark, lines, 1)), lst.parse_exchange(lines_df(spark, ex, 1))))
    b = rows(lst.report(fin.parse_financials(lines_df(spark, lines, 8)), lst.parse_exchange(lines_df(spark, ex, 8))))
    assert a == b


def test_blank_short_and_long_rows(spark):
    lines = [HDR, "", "   ", "SHORT,Name,Sec,1.0,2.0", line("OK", "1", "2"), line("LONG", "1", "2") + ",extra,more"]
    f = fin.parse_financials(lines_df(spark, lines, 2))
    assert f.count() == 3  # blank lines are not records
    assert sorted(r.symbol for r in fin.clean(f).collect()) == ["LONG", "OK"]
    c = fin.counts(f).first()
    assert (c.valid, c.invalid, c.no_dividend, c.no_pe) == (2, 1, 0, 0)
    d = lst.join_both_details(f, lst.parse_exchange(lines_df(spark, [exchange("OK"), ""])))
    assert not [c for c in d.columns if c.startswith("fin__") or c.startswith("ex__")]
