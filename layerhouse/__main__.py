"""Command line: ``python -m layerhouse <step> --landing <folder>``.

Steps: generate, bronze, silver, dimensions, gold, run (the four before), check, changes, clean. Tables live in
the session's catalogue, so separate calls need a persistent one. The exit code is 1 if ``check`` finds a
violation, or if a step keeps an old version because required values are missing.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import uuid

from layerhouse.plans import generate, warehouse
from layerhouse.session import build_session

STEPS = ("generate", "bronze", "silver", "dimensions", "gold", "run", "check", "changes", "clean")


def parse(arguments=None) -> argparse.Namespace:
    now = dt.datetime.now(dt.timezone.utc)
    parser = argparse.ArgumentParser(prog="layerhouse")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--landing", help="folder of the source files")
    parser.add_argument("--batch-id", default=uuid.uuid4().hex[:8])
    parser.add_argument("--batch-ts", default=now.strftime("%Y-%m-%d %H:%M:%S"), help="UTC")
    parser.add_argument("--orders", type=int, default=100_000, help="orders to generate")
    parser.add_argument("--products", type=int, default=500, help="products to generate")
    parser.add_argument("--customers", type=int, default=10_000, help="customers to generate")
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--first-year", type=int, default=2020, help="of the calendar")
    parser.add_argument("--last-year", type=int, default=2030, help="of the calendar")
    parser.add_argument("--drop-old-versions", action="store_true", help="at the end of a run")
    found = parser.parse_args(arguments)
    if found.landing is None and found.step not in ("gold", "check", "changes", "clean"):
        parser.error("--landing is needed")
    return found


def execute(spark, args: argparse.Namespace) -> int:
    batch, years = (args.batch_id, args.batch_ts), (args.first_year, args.last_year)
    if args.step == "generate":
        generate.write_landing(spark, args.landing, args.products, args.customers, args.orders, args.seed)
        return 0
    if args.step == "check":
        found = warehouse.report(spark)
        for name, n in found.items():
            print(f"{name}: {n:,} rows in {warehouse.FINDINGS}")
        return int(any(n for name, n in found.items() if name not in warehouse.INFORMATION))
    if args.step == "changes":
        for name, n in warehouse.record_changes(spark).items():
            print(f"{name}: {n:,} rows added")
        return 0
    if args.step == "clean":
        print("\n".join(warehouse.clean(spark)))
        return 0
    steps = {
        "bronze": lambda: warehouse.ingest_bronze(spark, args.landing, *batch),
        "silver": lambda: warehouse.build_silver(spark, args.landing, *batch),
        "dimensions": lambda: warehouse.update_dimensions(spark, args.landing, *batch),
        "gold": lambda: warehouse.build_gold(spark, args.batch_id, *years),
        "run": lambda: warehouse.run(spark, args.landing, *batch, *years, keep_versions=not args.drop_old_versions),
    }
    written = steps[args.step]()
    for table, n in written.items():
        print(f"{table}: {n:,} rows" if n >= 0 else f"{table}: rejected, the old version stays")
    return int(any(n < 0 for n in written.values()))


if __name__ == "__main__":
    sys.exit(execute(build_session(), parse()))
