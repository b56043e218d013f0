"""Run the whole job: ``python -m stockledger`` or ``spark-submit bin/stockledger_job.py``.

Inputs are either the three retail tables or a folder of driver tables
(``--driver-tables``, seen through the adapter of FIXTURES.md §4).
"""

from __future__ import annotations

import argparse
import datetime as dt

import os

from .config import ADAPTER_PERIOD, RETAIL_PERIOD, Period, build_session, size_shuffle_partitions
from .plans.job import run_checks, run_job
from .sources.adapter import driver_tables
from .sources.published import prune_runs, verify_outputs
from .sources.tables import RetailTables


def _period(args) -> Period:
    base = ADAPTER_PERIOD if args.driver_tables else RETAIL_PERIOD
    opening = dt.date.fromisoformat(args.opening) if args.opening else base.opening
    closing = dt.date.fromisoformat(args.closing) if args.closing else base.closing
    years = tuple(int(y) for y in args.years.split(",")) if args.years else (
        base.years if not (args.opening or args.closing) else ()
    )
    dpy = "calendar" if args.calendar_days else 365
    return Period(opening, closing, years, dpy)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="stockledger", description=__doc__)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--driver-tables", help="folder with part/lineitem/orders parquet")
    src.add_argument("--products", help="products parquet (with --sales and --movements)")
    ap.add_argument("--sales", help="sales parquet")
    ap.add_argument("--movements", help="signed stock movements parquet")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--opening", help="opening day, YYYY-MM-DD (earlier balances fold onto it)")
    ap.add_argument("--closing", help="closing day, YYYY-MM-DD (later movements are ignored)")
    ap.add_argument("--years", help="comma-separated reporting years")
    ap.add_argument("--calendar-days", action="store_true", help="mean stock over 365/366 days")
    ap.add_argument(
        "--no-root-fanout", action="store_true",
        help="family stock counts each (root, family) once, not once per product",
    )
    ap.add_argument(
        "--known-products-only", action="store_true",
        help="store list from movements of known products only",
    )
    ap.add_argument("--skip-daily", action="store_true", help="do not write the daily table")
    ap.add_argument("--versioned", action="store_true", help="publish all tables at once, as a set of their own")
    ap.add_argument("--keep-sets", type=int, help="with --versioned: delete all published sets but this many afterwards")
    ap.add_argument("--validate", action="store_true", help="run the data-quality checks afterwards")
    ap.add_argument(
        "--skip-daily-check", action="store_true",
        help="validate without V3, which shuffles the whole daily table",
    )
    ap.add_argument("--master", help="only for local runs; spark-submit sets it otherwise")
    args = ap.parse_args(argv)
    if args.keep_sets is not None and (not args.versioned or args.keep_sets < 1):
        ap.error("--keep-sets needs --versioned and at least 1")

    spark = build_session(args.master)
    if args.driver_tables:
        inputs = [os.path.join(args.driver_tables, f"{t}.parquet") for t in ("lineitem", "orders")]
    else:
        if not (args.sales and args.movements):
            ap.error("--products needs --sales and --movements")
        inputs = [args.sales, args.movements]
    # shuffle partitions from the fact tables' size, unless set at submit time
    size_shuffle_partitions(spark, inputs)
    if args.driver_tables:
        tables = driver_tables(spark, args.driver_tables)
    else:
        tables = RetailTables.from_parquet(spark, args.products, args.sales, args.movements)
    res = run_job(
        tables,
        args.out,
        _period(args),
        root_fanout=not args.no_root_fanout,
        known_products_only=args.known_products_only,
        daily=not args.skip_daily,
        versioned=args.versioned,
    )
    res.footprint(spark).orderBy("output").show(truncate=False)
    if args.validate:
        checks = run_checks(
            tables,
            args.out,
            _period(args),
            root_fanout=not args.no_root_fanout,
            check_daily=not args.skip_daily_check,
        )
        checks.show(truncate=False)
        if args.versioned:
            verify_outputs(spark, args.out).show(truncate=False)
    if args.keep_sets is not None:
        prune_runs(spark, args.out, args.keep_sets)


if __name__ == "__main__":
    main()
    build_session().stop()
