"""``spark-submit`` entry: load months of raw CSV, then build and check the tables.

    python -m shopfunnel --raw <folder> --processed <folder> --month 2019-10 --month 2019-11
"""

from __future__ import annotations

import argparse
import logging

from shopfunnel.plans.load import load_month
from shopfunnel.plans.refresh import refresh
from shopfunnel.plans.warehouse import build_event_tables, build_models
from shopfunnel.session import build_session
from shopfunnel.sources.csv import month_file


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shopfunnel")
    parser.add_argument("--raw", required=True, help="folder of the monthly CSV files")
    parser.add_argument("--processed", required=True, help="folder of the processed dataset")
    parser.add_argument("--quarantine", help="folder for rows that did not convert")
    parser.add_argument("--month", action="append", required=True, help="yyyy-MM, or yyyy-MM=<file or folder>,...; may be repeated")
    parser.add_argument("--database", default="default", help="database of the tables")
    parser.add_argument("--load-only", action="store_true", help="stop after the processed dataset")
    parser.add_argument("--may-empty", action="store_true", help="accept a delivery without rows of its month")
    parser.add_argument("--versioned", action="store_true", help="publish each month in one step")
    parser.add_argument("--refresh", action="store_true", help="build only the loaded months of the tables anew")
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="{asctime} [{levelname}] {message}", style="{")
    spark = build_session()
    for delivery in args.month:
        month, _, paths = delivery.partition("=")
        files = paths.split(",") if paths else month_file(args.raw, month)
        load_month(spark, files, args.processed, month, args.quarantine, args.may_empty, args.versioned)
    if not args.load_only:
        if args.refresh:
            results = refresh(spark, args.processed, args.database, [m.partition("=")[0] for m in args.month])
        else:
            build_event_tables(spark, args.processed, args.database)
            results = build_models(spark, args.database)
        for model, column, name, failures in results:
            logging.info("check %s.%s %s: %s failing rows", model, column, name, failures)


if __name__ == "__main__":
    main()
