"""Driver program: ``python -m contrail <command>`` (or via ``spark-submit``).

Commands
--------
ingest  load the raw delimited files into raw tables (monthly sources for the
        selected months) and append the load audit
build   build staging views, dimensions, the incremental fact, marts, the
        snapshot and the check report from the raw tables
status  row counts of the raw tables and the latest audit rows
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from contrail.session import get_session
from contrail.sources.readers import SOURCES, read_seed, read_source


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="contrail")
    sub = p.add_subparsers(dest="command", required=True)
    ing = sub.add_parser("ingest", help="load raw files into raw tables")
    ing.add_argument("--raw-dir", required=True, help="folder holding the delimited source files")
    ing.add_argument("--warehouse", required=True, help="warehouse root (shared storage)")
    ing.add_argument("--months", default="all", help="comma-separated YYYY-MM list, or 'all'")
    ing.add_argument("--reject-limit", type=int, help="bad rows allowed in each source; they go to raw/rejects (default: the first one fails the load)")
    bld = sub.add_parser("build", help="build every model from the raw tables")
    bld.add_argument("--warehouse", required=True)
    bld.add_argument("--full-refresh", action="store_true")
    bld.add_argument("--lookback-days", type=int, default=0)
    bld.add_argument("--fixed-dates", action="store_true", help="flights never change their date: merges needn't look for old places of keys")
    bld.add_argument("--hubs", default="EWR,JFK,LGA", help="accepted origin codes")
    bld.add_argument("--no-gate", action="store_true", help="build on when checks fail")
    bld.add_argument("--warn-only", default="", help="comma-separated checks that are reported and gate nothing")
    bld.add_argument("--fail-on-violation", action="store_true")
    bld.add_argument("--holidays", help="holiday seed file (default: the federal holidays by rule)")
    st = sub.add_parser("status", help="raw table counts and the latest loads")
    st.add_argument("--warehouse", required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_session()
    root = args.warehouse.rstrip("/")
    if args.command == "ingest":
        from contrail.operators.sinks import parse_months
        from contrail.plans.ingest import ingest
        months = None if args.months == "all" else [m.strip() for m in args.months.split(",") if m.strip()]
        if months is not None:
            parse_months(months)  # reject malformed months before any job runs
        on_bad = "fail" if args.reject_limit is None else "keep"
        raw = {s.name: read_source(spark, s, args.raw_dir, on_bad=on_bad) for s in SOURCES}
        counts = ingest(spark, raw, f"{root}/raw", months=months, reject_limit=args.reject_limit or 0)
        for name, per in counts.items():
            print(f"loaded {sum(per.values())} rows into {name}")
        return 0
    if args.command == "build":
        from contrail.plans.build import build
        from contrail.operators.sinks import read_raw
        raw = {s.name: read_raw(spark, f"{root}/raw/{s.name}") for s in SOURCES}
        result = build(spark, f"{root}/warehouse", raw, hubs=tuple(args.hubs.split(",")),
                       as_of=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
                       full_refresh=args.full_refresh, lookback_days=args.lookback_days, fixed_partition=args.fixed_dates,
                       fail_on_violation=args.fail_on_violation, gate=not args.no_gate,
                       warn_only=tuple(filter(None, args.warn_only.split(","))),
                       holidays=read_seed(spark, path=args.holidays) if args.holidays else None)
        failed = result.report.where("not passed").count()
        print(f"built {len(result.warehouse.written)} tables; {failed} of {result.report.count()} checks failed")
        return 1 if failed and args.fail_on_violation else 0
    if args.command == "status":
        from contrail.operators.sinks import read_raw, recent_loads, table_counts, table_exists
        present = {s.name: f"{root}/raw/{s.name}" for s in SOURCES if table_exists(spark, f"{root}/raw/{s.name}")}
        if not present:
            print(f"no raw tables under {root}")
            return 0
        table_counts({n: read_raw(spark, p) for n, p in sorted(present.items())}).orderBy("table_name").show(truncate=False)
        recent_loads(spark.read.parquet(f"{root}/raw/load_audit"), 10).show(truncate=False)
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
