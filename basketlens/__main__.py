"""Command line: ``python -m basketlens JOB --root FOLDER``, under spark-submit or on one machine."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from basketlens.operators import segmentation as seg
from basketlens.operators.series import model_errors
from basketlens.plans import jobs
from basketlens.session import scratch, ship_package
from basketlens.sources import sql, tables as store


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="basketlens")
    parser.add_argument("job", choices=["load", "append", "compact", "drop-old", "segment", "churn", "forecast", "dashboard", "all", "sql"])
    parser.add_argument("--root", required=True, help="folder of the tables and reports")
    parser.add_argument("--raw", nargs="+", help="raw invoice lines (CSV)")
    parser.add_argument("--home-country", default="United Kingdom")
    parser.add_argument("--file", help="statements over the views and table functions, for sql")
    parser.add_argument("--buckets", type=int, help="buckets of the fact tables; by default they follow from the bytes")
    parser.add_argument("--keep", type=int, default=1, help="loads that drop-old leaves")
    parser.add_argument("--restarts", type=int, default=10, help="k-means starts per k")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"basketlens-{args.job}").getOrCreate()
    ship_package(spark)

    if args.job in ("load", "append", "all") and not args.raw:
        parser.error("--raw is required to load")
    if args.job == "sql" and not args.file:
        parser.error("--file is required for sql")
    with scratch(spark):
        run(spark, args)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "load":
        print(jobs.load(spark, args.raw, args.root, args.buckets))
    elif args.job == "append":
        print(jobs.append(spark, args.raw, args.root))
    elif args.job == "compact":
        print(store.compact_tables(spark, args.root))
    elif args.job == "drop-old":
        print(store.drop_old_loads(spark, args.root, args.keep))
    elif args.job == "all":
        jobs.run_all(spark, args.root, args.raw, restarts=args.restarts, home_country=args.home_country, buckets=args.buckets)
    elif args.job == "sql":
        sql.register(spark, store.read_tables(spark, args.root))
        sql.run_file(spark, args.file).show(100, truncate=False)
    elif args.job == "dashboard":
        jobs.write_dashboard(spark, args.root, args.home_country)
    else:
        folder, tables = store.current(spark, args.root), store.read_tables(spark, args.root)
        if args.job == "segment":
            result = jobs.segment(tables, restarts=args.restarts)
            jobs.write_segmentation(result, folder)
            for k, _, score, low, high, chosen, decided in seg.search_rows(result.search):
                print(f"k = {k}: {score:.4f} ({low:.4f} to {high:.4f})", "chosen" * chosen, "undecided" * (chosen and not decided))
            print("beats naive:", result.beats_naive)
        elif args.job == "churn":
            result = jobs.churn(tables, store.read_segments(spark, folder), home_country=args.home_country)
            jobs.write_churn(result, folder, args.home_country)
            print("threshold:", result.threshold_days, result.test.first().asDict())
        else:
            result = jobs.forecast(tables)
            jobs.write_forecast(result, folder)
            print(result.choice, model_errors(result.backtest).first().asDict())


if __name__ == "__main__":
    main()
