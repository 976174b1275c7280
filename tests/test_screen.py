from decimal import Decimal

from cinder.operators import screen as scr
from conftest import lines_df, rows

H = '"Symbol","Name","LastSale","MarketCap","IPOyear","Sector","industry","Summary Quote",'


def rec(sym, cap, sector):
    return f'"{sym}","{sym}, Inc.","1.00","{cap}","n/a","{sector}","ind","url",'


LINES = [
    H,
    rec("AAA", "$1.5M", "Tech"),
    rec("BBB", "$2B", "Tech"),
    rec("CCC", "$300", "Tech"),
    rec("DDD", "n/a", "Tech"),
    rec("TORM          ", "$10.25M", "Energy"),  # padded symbol kept, one-row sector
    rec("EEE", "$1M", "n/a"),
    rec("FFF", "$1.234M", "Energy"),
    rec("GGG", "$.5M", "Dots"),
    rec("HHH", "$5.M", "Dots"),
    rec("III", "$1,200.5M", "Dots"),  # no amount: rejected, neither counted nor summed
    '"SHORT","x","1"',  # short row
    "",  # blank line: a reject, not a record
    rec("LONG", "$1M", "Tech") + "extra,",  # over-long row
    H,  # a header again (multi-file input)
]


def test_parse_and_rejects(spark):
    parsed = scr.parse_listing(lines_df(spark, LINES, 3))
    recs = scr.listing_records(parsed)
    assert sorted(r.symbol for r in recs.collect()) == ["AAA", "BBB", "CCC", "DDD", "EEE", "FFF", "GGG", "HHH", "III", "TORM          "]
    rej = rows(scr.listing_rejects(parsed))
    assert sorted(r[1] for r in rej) == [1, 3, 10]


def test_units_and_screens(spark):
    recs = scr.listing_records(scr.parse_listing(lines_df(spark, LINES)))
    caps = {r.symbol: (r.cap_unit, r.cap_usd) for r in scr.cap_normalize(recs).collect()}
    assert caps["AAA"] == ("M", Decimal("1500000.00"))
    assert caps["BBB"] == ("B", Decimal("2000000000.00"))
    assert caps["CCC"] == ("", Decimal("300.00"))  # no suffix: plain dollars, not millions
    assert caps["DDD"] == (None, Decimal("0.00"))
    assert caps["FFF"] == ("M", Decimal("1234000.00"))  # decimals kept until scaled
    million = {r.sector: (r.company_count, r.total_cap) for r in scr.screen(recs).collect()}
    assert million == {"Tech": (3, Decimal("1500300.00")), "Energy": (2, Decimal("11484000.00")),
                       "n/a": (1, Decimal("1000000.00")), "Dots": (2, Decimal("5500000.00"))}
    assert rows(scr.cap_rejects(recs)) == [("III", "$1,200.5M")]
    billion = {r.sector: r.company_count for r in scr.screen(recs, billion=True).collect()}
    assert billion == {"Tech": 1}
    known = {r.sector for r in scr.screen(recs, known_sectors_only=True).collect()}
    assert known == {"Tech", "Energy", "Dots"}


def test_formatted_and_symbols(spark):
    recs = scr.listing_records(scr.parse_listing(lines_df(spark, LINES)))
    fm = {r.sector_label: r.total_market_cap for r in scr.screen_formatted(recs).collect()}
    assert fm["Sector: Tech"] == "$1,500,300.00"
    syms = {(r.sector, r.part): r.symbols for r in scr.screen_symbols(recs, chunk_size=2).collect()}
    assert syms[("Tech", 0)] == "AAA, CCC" and syms[("Tech", 1)] == "DDD"


def test_counters(spark):
    c = {(r.sector, r.is_total): (r.attempted, r.processed)
         for r in scr.screen_counters(scr.parse_listing(lines_df(spark, LINES))).collect()}
    assert c[(None, True)] == (13, 8)  # data rows only (headers not attempted)
    assert c[("Tech", False)] == (5, 3)


def test_partition_independent(spark):
    many = [H] + [rec(f"S{i:04d}", f"${i}.5M", f"Sec{i % 3}") for i in range(300)]
    a = rows(scr.screen(scr.listing_records(scr.parse_listing(lines_df(spark, many, 1)))))
    b = rows(scr.screen(scr.listing_records(scr.parse_listing(lines_df(spark, many, 8)))))
    assert a == b
    s1 = rows(scr.screen_symbols(scr.listing_records(scr.parse_listing(lines_df(spark, many, 1))), chunk_size=7))
    s8 = rows(scr.screen_symbols(scr.listing_records(scr.parse_listing(lines_df(spark, many, 8))), chunk_size=7))
    assert s1 == s8


def test_screen_sql_route_agrees(spark):
    """Two implementations, one answer: SQL text over the parsed records vs the operator."""
    from conftest import SF_SMALL

    from cinder.plans import catalog as C

    recs = scr.listing_records(C._listing(spark, SF_SMALL))
    recs.createOrReplaceTempView("listing_records_v")
    for billion in (False, True):
        cond = "endswith(market_cap, 'B')" if billion else "NOT coalesce(endswith(market_cap, 'B'), false)"
        sql = spark.sql(f"""
            SELECT sector, count(*) AS company_count,
                   CAST(sum(CAST(CASE WHEN lower(trim(market_cap)) = 'n/a' THEN 0
                                 WHEN market_cap LIKE '%B' THEN try_cast(substr(market_cap, 2, length(market_cap) - 2)
                                                                     AS DECIMAL(26,12)) * 1000000000
                                 WHEN market_cap LIKE '%M' THEN try_cast(substr(market_cap, 2, length(market_cap) - 2)
                                                                     AS DECIMAL(26,12)) * 1000000
                                 ELSE CAST(substr(market_cap, 2) AS DECIMAL(26,12)) END AS DECIMAL(38,2))) AS DECIMAL(38,2)) AS total_cap
            FROM listing_records_v WHERE {cond} AND market_cap NOT LIKE '%,%' GROUP BY sector""")
        assert rows(sql) == rows(scr.screen(recs, billion=billion).select("sector", "company_count", "total_cap"))
