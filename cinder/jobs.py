"""File-to-file jobs: ``python -m cinder <job> <inputs...> <output> [options]``.

Each job reads text/CSV files, runs the DataFrame operators and writes with
the executors (nothing is collected). Output folders get an epoch-millis
suffix unless ``--exact-output`` is given, and an existing folder is never
overwritten.

  wordcount  IN OUT [--shards N]   (word,n) tuple lines in word order, or N
                                   key<TAB>count shards, each sorted
  screen     IN OUT [--billion] [--known-sectors] [--chunk N]
                                   per-sector totals, symbol lists and counters (CSV)
  financials IN OUT                cleaned (symbol,dividend,pe) tuple lines
  report     FIN EXCH OUT [--k N]  common symbols, total, top-k dividend/growth
  accesslog  IN OUT                regex-parsed access log as Parquet
  ratings    IN TABLE              create the typed ratings table if missing,
                                   replace its rows with the TSV, print the count
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from cinder import sinks
from cinder.functions.formatting import currency
from cinder.operators import financials as fin_ops
from cinder.operators import listing as lst
from cinder.operators import screen as scr
from cinder.operators import words
from cinder.operators.staging import release, stage
from cinder import tables
from cinder.sources.delimited import RATINGS_SCHEMA, read_typed_tsv
from cinder.sources.external import overwrite_load
from cinder.sources.regex_log import parse_access_log
from cinder.session import RECOMMENDED_CONF
from cinder.sources.text import read_lines


def _out(path: str, exact: bool) -> str:
    return path if exact else sinks.stamped_path(path)


def run(argv: list[str], spark: SparkSession | None = None) -> str:
    p = argparse.ArgumentParser(prog="cinder")
    sub = p.add_subparsers(dest="job", required=True)
    w = sub.add_parser("wordcount")
    w.add_argument("input")
    w.add_argument("output")
    w.add_argument("--shards", type=int, default=0)
    s = sub.add_parser("screen")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--billion", action="store_true")
    s.add_argument("--known-sectors", action="store_true")
    s.add_argument("--chunk", type=int, default=1000)
    f = sub.add_parser("financials")
    f.add_argument("input")
    f.add_argument("output")
    r = sub.add_parser("report")
    r.add_argument("financials")
    r.add_argument("exchange")
    r.add_argument("output")
    r.add_argument("--k", type=int, default=10)
    a = sub.add_parser("accesslog")
    a.add_argument("input")
    a.add_argument("output")
    rt = sub.add_parser("ratings")
    rt.add_argument("input")
    rt.add_argument("table")
    for sp in (w, s, f, r, a):
        sp.add_argument("--exact-output", action="store_true")
    args = p.parse_args(argv)
    if spark is None:
        builder = SparkSession.builder.appName(f"cinder-{args.job}")
        for k, v in RECOMMENDED_CONF.items():  # includes spark.ui.enabled=false
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    if args.job == "ratings":
        tables.create_table(spark, args.table, RATINGS_SCHEMA, comment="Ratings table")
        overwrite_load(read_typed_tsv(spark, args.input, RATINGS_SCHEMA), args.table)
        return str(spark.table(args.table).count())
    out = _out(args.output, args.exact_output)

    if args.job == "wordcount":
        counts = words.word_count(read_lines(spark, args.input))
        if args.shards:
            sinks.write_sharded(counts, out, "word", args.shards, "n")
        else:
            sinks.write_tuples(counts.orderBy("word"), out, ["word", "n"])
    elif args.job == "screen":
        parsed = stage(scr.parse_listing(read_lines(spark, args.input)), "listing")  # read and parsed once
        recs = scr.listing_records(parsed)
        totals = scr.screen(recs, billion=args.billion, known_sectors_only=args.known_sectors)
        totals.withColumn("total_market_cap", currency(totals["total_cap"])).orderBy("sector").write.mode(
            "errorifexists").option("header", True).csv(f"{out}/totals")
        scr.screen_symbols(recs, billion=args.billion, chunk_size=args.chunk).orderBy("sector", "part").write.mode(
            "errorifexists").option("header", True).csv(f"{out}/symbols")
        scr.screen_counters(parsed, billion=args.billion).write.mode("errorifexists").option("header", True).csv(f"{out}/counters")
        release(parsed)
    elif args.job == "financials":
        cleaned = fin_ops.clean_text(fin_ops.parse_financials(read_lines(spark, args.input)))
        sinks.write_tuples(cleaned.orderBy("symbol"), out, ["symbol", "dividend", "pe"])
    elif args.job == "report":
        rep = lst.report(fin_ops.parse_financials(read_lines(spark, args.financials)),
                         lst.parse_exchange(read_lines(spark, args.exchange)), args.k)
        rep.write.mode("errorifexists").option("header", True).csv(out)
    elif args.job == "accesslog":
        parse_access_log(read_lines(spark, args.input)).write.mode("errorifexists").parquet(out)
    return out


def main() -> None:
    print(run(sys.argv[1:]))


if __name__ == "__main__":
    main()
