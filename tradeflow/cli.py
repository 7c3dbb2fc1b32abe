"""Command line for the jobs, for ``spark-submit`` (or ``python -m tradeflow`` locally).

    spark-submit ... -m tradeflow create  --raw s3://b/raw/ --dest s3://b/trade --start-year 2015
    spark-submit ... -m tradeflow update  --raw s3://b/raw/ --dest s3://b/trade --official 2025-06
    spark-submit ... -m tradeflow update  --raw s3://b/raw/ --dest s3://b/trade --official s3://b/updated.json
    spark-submit ... -m tradeflow build-lookups --dest s3://b/trade --source country=s3://b/pub/PAIS.csv ...
    spark-submit ... -m tradeflow totals  --dest s3://b/trade --flow export --by year

The session comes from ``spark-submit`` (``getOrCreate``); each command prints
one JSON line with what it did.
"""

from __future__ import annotations

import argparse
import json
import re
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tradeflow", description="Foreign-trade statistics store on Spark")
    sub = p.add_subparsers(dest="command", required=True)

    c = sub.add_parser("create", help="load raw files into the store")
    c.add_argument("--raw", required=True, nargs="+", help="raw file paths, folders or globs")
    c.add_argument("--dest", required=True, help="store folder (export/ and import/ below it)")
    c.add_argument("--start-year", type=int, default=None)
    c.add_argument("--flows", nargs="+", default=["export", "import"], choices=["export", "import"])

    u = sub.add_parser("update", help="load the years the refresh rules pick")
    u.add_argument("--raw", required=True, nargs="+")
    u.add_argument("--dest", required=True)
    u.add_argument("--official", required=True,
                   help="last published period: 'yyyy-mm', or the path of a saved update-service JSON payload")
    u.add_argument("--start-year", type=int, default=None)
    u.add_argument("--current-year", type=int, default=None)

    b = sub.add_parser("build-lookups", help="build lookups from published files")
    b.add_argument("--dest", required=True)
    b.add_argument("--lookups", default=None, help="lookup folder (default <dest>/lookups)")
    b.add_argument("--source", action="append", required=True, metavar="NAME=PATH")

    t = sub.add_parser("totals", help="fob_value totals by year (or year and month)")
    t.add_argument("--dest", required=True)
    t.add_argument("--flow", choices=["export", "import"], default="export")
    t.add_argument("--by", choices=["year", "year-month"], default="year")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    """Run one command; ``argv`` defaults to the process arguments."""
    from tradeflow.api import TradeDB

    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tradeflow-{args.command}").getOrCreate()
    db = TradeDB(spark, args.dest, getattr(args, "lookups", None))
    if args.command == "create":
        files = db.create_cs_db(args.raw, start_year=args.start_year, flows=args.flows)
        out = {"command": "create", "files": {k: len(v) for k, v in files.items()}}
    elif args.command == "update":
        official = args.official
        if not re.match(r"^[0-9]{4}-[0-9]{2}$", official):  # a payload file: {"data": {"year": .., "monthNumber": ..}}
            from tradeflow.plans.refresh import official_period

            feed = spark.read.option("wholetext", "true").text(official).withColumnRenamed("value", "payload")
            official = official_period(feed)
        r = db.update_cs_db(args.raw, official, start_year=args.start_year, current_year=args.current_year)
        out = {"command": "update", "status": r["status"], "years": r["years"]}
    elif args.command == "build-lookups":
        sources = dict(s.split("=", 1) for s in args.source)
        out = {"command": "build-lookups", "saved": db.build_lookups(sources)}
    else:
        from tradeflow.operators.summaries import total_by_year, total_by_year_month

        store = db.open(args.flow)
        df = total_by_year(store) if args.by == "year" else total_by_year_month(store)
        keys = ["year"] if args.by == "year" else ["year", "month"]
        out = {"command": "totals", "rows": [r.asDict() for r in df.orderBy(*keys).collect()]}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
